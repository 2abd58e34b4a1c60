"""N-gram Jaccard join with adaptive multi-match prefixes.

A text's set holds its distinct k-word shingles as 64-bit hashes, ordered by
hash. If two sets of n and m shingles are similar enough, they share at least
a(n) = ceil(t * n) of them, and then any ``l`` satisfies: among the first
n - a(n) + l shingles of the one and m - a(m) + l of the other, at least ``l``
are common. So a longer prefix is allowed to demand more common shingles.

1. Every distinct set emits its prefix for l = n / 20; shingles are counted, and
   a set with fewer than ``l`` shared prefix shingles has no partner.
2. The survivors lengthen their prefixes by estimated cost. For a length ``l``
   a set may leave out the l - 1 most frequent shingles of its prefix and still
   meet each partner in one of the others; the cost is what those others' lists
   hold, and each set takes the ``l`` of least cost. Of a pair, the set of the
   smaller ``l`` finds the other: what it looks up (its probes) meets the other's
   prefix, which is as long at least.
3. A pair found must share ``l`` shingles of both prefixes, the smaller of the two,
   and is then verified exactly on the whole sets. First the members of each set's
   longest list are compared with a central one (whose shingles are the most
   frequent: the least edited copy), those not linked with it with the next, and
   so for ``PIVOTS`` of them. What is in one component then
   needs no further comparison; of all other pairs none is left out. Members of
   long lists are joined to clusters, dealt by size and hash to cells of bounded
   size, and each cell multiplies its incidence matrices and gives the links
   that join its components; short lists give their pairs one by one.

Defined cases: a text with fewer words than ``k`` is one shingle of all its
words; without words, or null, it is empty and linked with nothing; repeated
rows and exact copies form one class and are compared once; a null id is never
the smallest; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rxlake.llm.graph import components
from rxlake.llm.store import discard, free_name, keep, ship_code
from rxlake.llm.textkit import PLACE, mix, text_slices, windows_of, words_of

K = 5
WORD = r"[^\x20\x09-\x0D]"
#: Similarity as a fraction.
NUM, DEN = 4, 5
#: Prefix lengths: l is n divided by each of these (0: l is 1).
LEVELS = (0, 20, 8, 4)
#: Central members of a list that all others are compared with first.
PIVOTS = 3
#: Members of a list that is compared pair by pair; longer ones go to cells.
SHORT = 64
#: Sets that have a token, up to which a cell counts its pairs one by one.
LIGHT = 16
#: Sets in each side of a cell.
CELL = 1024
#: Parts of all first prefixes that are shuffled one after the other.
PARTS = 2


def least_common(n: np.ndarray | int) -> np.ndarray | int:
    return -(-NUM * n // DEN)


def length_of(n: int, level: int) -> int:
    return max(1, -(-n // level)) if level else 1


def shingle_sets(buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    w = words_of(buf, offs, fold_case=True)
    _, doc, h = windows_of(w, K)
    ends = np.searchsorted(doc, np.arange(len(offs)))
    for i in range(len(offs) - 1):
        x = h[ends[i] : ends[i + 1]]
        if not len(x) and w.first[i + 1] > w.first[i]:
            own = w.hash[w.first[i] : w.first[i + 1]]
            x = mix(np.array([(own * PLACE[: len(own)]).sum(dtype=np.uint64) + PLACE[40 + len(own)]]))
        if len(x) > 1:
            x = np.sort(x)
            x = x[np.append(True, x[1:] != x[:-1])]
        yield x


def digest(x: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return tuple(int(mix(x + PLACE[j]).sum(dtype=np.uint64).astype(np.int64)) for j in (50, 51))


def _lists(parts: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if p is None else len(p) for p in parts])
    at = np.append(0, np.cumsum(sizes)).astype(np.int32)
    flat = np.concatenate([p for p in parts if p is not None] or [np.zeros(0, np.uint64)]).astype(np.uint64).view(np.int64)
    mask = pa.array([p is None for p in parts])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat), mask=mask)


def _sketches(docs: DataFrame) -> DataFrame:
    """One row a document: rid, doc_id, row_key, hash of the text, d1, d2, n, and the
    first prefix of its set unless the same task has given one for an equal set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, seen = TaskContext.get().partitionId() << 33, set()
        for b in batches:
            for lo, hi, buf, offs in text_slices(b, "text"):
                prefix, keys, n = [], [], []
                if len(seen) > 500_000:
                    seen.clear()
                for x in shingle_sets(buf, offs):
                    keys.append(key := digest(x))
                    n.append(len(x))
                    prefix.append(None if key in seen or not len(x) else x[: len(x) - least_common(len(x)) + length_of(len(x), LEVELS[1])])
                    seen.add(key)
                d = np.array(keys, np.int64).reshape(-1, 2)
                ids = rid + np.arange(len(n))
                rid += len(n)
                cols = [pa.array(ids), *(b.column(i).slice(lo, hi - lo) for i in (0, 1, 2)), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(np.array(n, np.int64)), _lists(prefix)]
                yield pa.RecordBatch.from_arrays(cols, ["rid", "doc_id", "row_key", "h", "d1", "d2", "n", "prefix"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "row_key", F.xxhash64("text").alias("h"), "text").mapInArrow(run, f"rid bigint, doc_id {kind}, row_key string, h bigint, d1 bigint, d2 bigint, n bigint, prefix array<bigint>")


def _sets(found: DataFrame) -> DataFrame:
    """cid, n and the whole set for rows (text, cid, d1, d2) whose text has that digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid, d1, d2 = (b.column(i).to_numpy() for i in (1, 2, 3))
            for lo, _, buf, offs in text_slices(b, "text"):
                ids, sets = [], []
                for i, x in enumerate(shingle_sets(buf, offs)):
                    if digest(x) == (d1[lo + i], d2[lo + i]):
                        ids.append(cid[lo + i])
                        sets.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), _lists(sets)], ["cid", "n", "tokens"])

    return found.select("text", "cid", "d1", "d2").mapInArrow(run, "cid bigint, n bigint, tokens array<bigint>")


def _probes(rows: DataFrame) -> DataFrame:
    """token, cid, n, need (l), probe, df, weight (mean df of the set's longest
    prefix) for each shared shingle of the prefix that a set has chosen.

    ``rows``: cid, n, shared: array of (pos, df, token)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                cid, n = part.column(0).to_numpy(), part.column(1).to_numpy()
                shared = part.column(2)
                flat = shared.flatten()
                pos, df, token = (flat.field(i).to_numpy() for i in range(3))
                ends = np.append(0, np.cumsum(shared.value_lengths().to_numpy()))
                probe, inside, need = np.zeros(len(pos), bool), np.zeros(len(pos), bool), np.zeros(len(n), np.int64)
                for i, m in enumerate(n):
                    a, z = ends[i], ends[i + 1]
                    need[i], inside[a:z], probe[a:z] = choose(int(m), pos[a:z], df[a:z], token[a:z])
                row = np.repeat(np.arange(len(n)), np.diff(ends))
                weight = np.bincount(row, df, len(n)) / np.maximum(n, 1)
                cols = {"token": token, "cid": cid[row], "n": n[row], "need": need[row], "probe": probe, "df": df, "weight": weight[row]}
                yield pa.RecordBatch.from_pydict({c: pa.array(x[inside]) for c, x in cols.items()})

    return rows.mapInArrow(run, "token bigint, cid bigint, n bigint, need bigint, probe boolean, df bigint, weight double")


def choose(n: int, pos: np.ndarray, df: np.ndarray, token: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """The length ``l`` of a set, and which of its shared shingles (place in the set,
    sets that have it) are in the prefix, and are looked up: for each length, those
    left without its l - 1 most frequent ones, if there are ``l`` at all; of these
    choices the one whose lists are shortest."""
    base = n - least_common(n)
    none = np.zeros(len(pos), bool)
    best, chosen = None, (0, none, none)
    for level in LEVELS:
        need = length_of(n, level)
        inside = pos < base + need
        at = np.flatnonzero(inside)
        if len(at) < need:
            return 0, none, none  # no partner can share enough
        # Rarest first, in an order that is the same for all sets.
        order = at[np.lexsort((token[at], df[at]))][: len(at) - need + 1]
        cost = float((df[order] - 1).sum()) + 0.5 * need
        if best is None or cost < best:
            probe = none.copy()
            probe[order] = True
            best, chosen = cost, (need, inside, probe)
    return chosen


def _shared(postings: DataFrame) -> DataFrame:
    """``postings`` (token, ...) of tokens that occur twice or more, with df.
    Both sides of the join read one and the same exchange."""
    dealt = postings.repartition("token")
    counts = dealt.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    return dealt.join(counts, "token")


def _verify(pairs: DataFrame, prefixes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of ``pairs``: those that share enough of their prefixes (cid, need,
    prefix), and then enough of the whole."""
    one = prefixes.select(F.col("cid").alias("a"), F.col("need").alias("la"), F.col("prefix").alias("pa"))
    two = prefixes.select(F.col("cid").alias("b"), F.col("need").alias("lb"), F.col("prefix").alias("pb"))
    enough = F.size(F.array_intersect("pa", "pb")) >= F.least("la", "lb")
    near = pairs.join(one, "a").join(two, "b").where(enough).select("a", "b")
    one = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb")).cast("long")
    return near.join(one, "a").join(two, "b").where(DEN * common >= NUM * (F.col("na") + F.col("nb") - common)).select("a", "b")


def _sizes_fit(n: Column, m: Column) -> Column:
    return (DEN * F.least(n, m)) >= (NUM * F.greatest(n, m))


def link_classes(sets: DataFrame, lists: DataFrame) -> DataFrame:
    """node, label of all sets linked with another. ``lists``: as from ``_probes``."""
    every = keep(lists, "lists")
    prefixes = keep(every.groupBy("cid", "need").agg(F.collect_list("token").alias("prefix")), "prefixes")
    # A list without a probe is never looked up.
    looked = every.groupBy("token").agg(F.count_if("probe").alias("p")).where("p > 0").select("token")
    lists = keep(every.drop("need").join(looked, "token"), "lists")
    discard(every)
    # Only sets in such a list are ever compared.
    whole, sets = sets, keep(sets.join(lists.select("cid").distinct(), "cid", "left_semi"), "compared")
    discard(whole)
    nth = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("df"), "token"))
    tops = lists.select("token", "cid", "n", "weight", nth.alias("nth")).where("nth = 1").withColumn("label", F.col("cid"))
    central = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("weight"), "cid"))
    tops = keep(tops, "tops")
    pivots = keep(tops.withColumn("r", central).where(F.col("r") <= PIVOTS), "pivots")
    links, rest = None, tops
    for r in range(1, PIVOTS + 1):
        found = keep(_verify(_pairs(pivots.where(F.col("r") == r), rest), prefixes, sets), "links")
        links = found if links is None else links.union(found)
        # Linked with the pivot of its list: the others add nothing.
        own = pivots.where(F.col("r") == r).select("token", F.col("cid").alias("pivot"))
        met = rest.join(own, "token").join(found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b"))), (F.col("cid") == F.col("a")) & (F.col("pivot") == F.col("b")), "left_semi")
        rest = rest.join(met.select("cid"), "cid", "left_anti")
    links = keep(links, "links")
    labels = components(links)
    lists = lists.select("token", "cid", "n", "probe")
    # Long lists, by cells.
    left = keep(_open(lists, labels), "open")
    size = left.groupBy("token").agg(F.count("*").alias("size"), F.min("cid").alias("first")).where(F.col("size") > SHORT)
    members = keep(left.join(size, "token").select("cid", "n", "label", "first"), "members")
    if not members.isEmpty():
        links = keep(links.union(_by_cells(members, sets)), "links")
        labels = components(links)
    discard(left, members)
    # Short ones, pair by pair.
    left = _open(lists, labels)
    size = left.groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") <= SHORT).select("token")
    left = keep(left.join(size, "token"), "open")
    links = keep(links.union(_verify(_pairs(left.where("probe"), left), prefixes, sets)), "links")
    discard(left, lists, sets, prefixes, tops, pivots)
    return components(links)


def _open(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``lists`` with labels, without those of one label."""
    state = lists.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    differ = state.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count_if("probe").alias("p"))
    return state.join(differ.where("x <> y AND p > 0").select("token"), "token")


def _pairs(some: DataFrame, members: DataFrame) -> DataFrame:
    pairs = some.alias("p").join(members.alias("s"), "token").where((F.col("p.label") != F.col("s.label")) & _sizes_fit(F.col("p.n"), F.col("s.n")))
    return pairs.select(F.least("p.cid", "s.cid").alias("a"), F.greatest("p.cid", "s.cid").alias("b")).distinct()


def _by_cells(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join the labels of ``members`` (cid, n, label, first:
    a member of the same list, common to the list).

    Sets of one cluster (lists that meet) lie in bands of size, each wider than
    the similarity allows two sets to differ, so that partners are in one band or
    in two that adjoin; a band is dealt to chunks of about CELL sets by hash, and
    two chunks make a cell."""
    near = members.select(F.col("cid").alias("a"), F.col("first").alias("b"))
    cluster = components(near).select(F.col("node").alias("cid"), F.col("label").alias("cluster"))
    rows = members.select("cid", "n", "label").distinct().join(cluster, "cid")
    rows = rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / float(np.log(DEN / NUM + 1e-9))).cast("int"))
    bands = rows.groupBy("cluster", "band").agg(F.ceil(F.count("*") / CELL).cast("int").alias("chunks"))
    bands = keep(bands, "bands")
    rows = rows.join(bands, ["cluster", "band"])
    for step, name in ((-1, "below"), (1, "above")):
        other = bands.select("cluster", (F.col("band") - step).alias("band"), F.col("chunks").alias(name))
        rows = rows.join(other, ["cluster", "band"], "left").withColumn(name, F.coalesce(name, F.lit(0)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))

    def cells(count: Column, make) -> Column:
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), make)).otherwise(F.array().cast("array<struct<band:int,up:boolean,i:int,j:int>>"))

    def cell(band: Column, up: bool, i: Column, j: Column) -> Column:
        return F.struct(band.cast("int").alias("band"), F.lit(up).alias("up"), i.cast("int").alias("i"), j.cast("int").alias("j"))

    c, b = F.col("chunk"), F.col("band")
    own = cells(F.col("chunks"), lambda k: cell(b, False, F.least(c, k), F.greatest(c, k)))
    up = cells(F.col("above"), lambda k: cell(b, True, c, k))
    down = cells(F.col("below"), lambda k: cell(b - 1, True, k, c))
    dealt = rows.select("cid", "n", "label", "cluster", F.explode(F.concat(own, up, down)).alias("cell"))
    full = dealt.join(sets.select("cid", "tokens"), "cid")
    return full.groupBy("cluster", "cell").applyInArrow(_join_cell, "a bigint, b bigint")


def _join_cell(part: pa.Table) -> pa.Table:
    """Links between sets of different labels, as many as join the components."""
    part = part.combine_chunks()
    cid, n, label = (part.column(c).to_numpy() for c in ("cid", "n", "label"))
    lists = part.column("tokens").combine_chunks()
    row = np.repeat(np.arange(len(cid)), lists.value_lengths().to_numpy())
    common = overlaps(row, lists.flatten().to_numpy(), len(cid))
    # Counts are whole numbers below 2**24, exact in these floats.
    a, b = np.nonzero(np.triu((DEN + NUM) * common >= NUM * (n[:, None] + n[None, :]).astype(np.float32), 1))
    group = {x: x for x in np.unique(label).tolist()}

    def top(x: int) -> int:
        while group[x] != x:
            group[x] = x = group[group[x]]
        return x

    out = []
    for i, j in zip(a[label[a] != label[b]].tolist(), b[label[a] != label[b]].tolist(), strict=True):
        x, y = top(int(label[i])), top(int(label[j]))
        if x != y:
            group[x] = y
            out.append((i, j))
    i, j = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": cid[i].astype(np.int64), "b": cid[j].astype(np.int64)})


def overlaps(row: np.ndarray, token: np.ndarray, m: int, block: int = 2048) -> np.ndarray:
    """Common tokens of each two of ``m`` sets: dense products for tokens that
    many have, pairs for those that few have; tokens of one set count only for it."""
    _, col, count = np.unique(token, return_inverse=True, return_counts=True)
    common = np.zeros((m, m), np.float32)
    heavy = np.flatnonzero(count > LIGHT)
    for lo in range(0, len(heavy), block):
        place = np.full(len(count), -1)
        own = heavy[lo : lo + block]
        place[own] = np.arange(len(own))
        x = np.zeros((m, len(own)), np.float32)
        ok = place[col] >= 0
        x[row[ok], place[col[ok]]] = 1
        common += x @ x.T
    order = np.argsort(col, kind="stable")
    by_col, own = row[order], count[col[order]]
    for df in range(2, LIGHT + 1):
        same = by_col[own == df].reshape(-1, df)
        for i in range(df if len(same) else 0):
            for j in range(i):
                np.add.at(common, (same[:, i], same[:, j]), 1)
                np.add.at(common, (same[:, j], same[:, i]), 1)
    return common


def near_duplicates(docs: DataFrame, row_key: Column | None = None) -> DataFrame:
    """One row a document: rid, doc_id, row_key (as given), n_shingles, class_id, label (equal for
    all documents that links connect), component_id (their smallest doc_id)."""
    ship_code(docs.sparkSession)
    key = F.lit(None).cast("string") if row_key is None else row_key
    first = keep(_sketches(docs.select("doc_id", "text", key.alias("row_key"))), "sketches")
    whole = first.where("n > 0").groupBy("d1", "d2", "n").agg(F.min(F.when(F.col("prefix").isNotNull(), F.col("rid"))).alias("cid"))
    classes = keep(whole, "classes")
    reps = first.where("prefix IS NOT NULL").join(classes.select(F.col("cid").alias("rid")), "rid", "left_semi")
    postings = reps.select(F.explode("prefix").alias("token"), F.col("rid").alias("cid"))
    need = F.greatest(F.lit(1), F.ceil(F.col("n") / LEVELS[1]))
    # A part of the shingles at a time, so that the shuffle of one is gone before the next.
    counted = [keep(_shared(postings.where(F.pmod("token", F.lit(PARTS)) == i)).groupBy("cid").agg(F.count("*").alias("n")), "shared") for i in range(PARTS)]
    shared = reduce(DataFrame.union, counted).groupBy("cid").agg(F.sum("n").alias("k"))
    alive = first.select("rid", "doc_id", "h", "d1", "d2", "n").join(shared, F.col("rid") == F.col("cid")).where(F.col("k") >= need)
    alive = keep(alive.select("cid", F.col("doc_id").alias("rep"), F.col("h").alias("rep_h"), "d1", "d2"), "alive")
    discard(*counted)
    rows = keep(first.drop("h", "prefix"), "rows")
    discard(first)
    # By id and text: rows of a null or frequent id meet only rows of their own text.
    mine = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    texts = mine.join(alive, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("h") == F.col("rep_h")))
    sets = keep(_sets(texts).dropDuplicates(["cid"]), "sets")
    longest = F.col("n") - F.ceil(F.col("n") * NUM / DEN) + F.greatest(F.lit(1), F.ceil(F.col("n") / LEVELS[-1]))
    index = sets.select("cid", F.posexplode(F.slice("tokens", F.lit(1), longest.cast("int"))).alias("pos", "token"))
    shared = _shared(index).groupBy("cid").agg(F.collect_list(F.struct(F.col("pos").cast("long"), "df", "token")).alias("shared"))
    labels = link_classes(sets, _probes(shared.join(sets.select("cid", "n"), "cid").select("cid", "n", "shared")))
    member = classes.join(labels, classes["cid"] == labels["node"], "left").select("d1", "d2", "n", "cid", F.coalesce("label", "cid").alias("label"))
    full = rows.select("rid", "doc_id", "row_key", "d1", "d2", "n").join(member, ["d1", "d2", "n"], "left")
    full = keep(full.select("rid", "doc_id", "row_key", F.col("n").alias("n_shingles"), F.col("cid").alias("class_id"), F.coalesce("label", "rid").alias("label")), "members")
    least = full.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return full.join(least, "label").select("rid", "doc_id", "row_key", "n_shingles", "class_id", "label", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group that links connect: that of the
    smallest id. Documents without words stay, each of them. Rows that agree in
    id and text are one document repeated; any one of them stays."""
    row_key, nth = free_name(docs, "_row_key", "_nth")
    key = F.md5(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("\x1e")), F.col("text")))
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    near = near_duplicates(docs, key).where("n_shingles > 0")
    # Smallest id first, a null id last; the minimum is taken before the shuffle.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    stay = near.groupBy("label").agg(F.min_by("row_key", order).alias(row_key)).select(row_key)
    stay = keep(stay.distinct(), "stay")
    full = docs.where(worded).withColumn(row_key, key).join(stay, row_key, "left_semi")
    once = full.withColumn(nth, F.row_number().over(Window.partitionBy(row_key).orderBy(row_key))).where(F.col(nth) == 1)
    return once.select(*docs.columns).unionByName(docs.where(~worded))
