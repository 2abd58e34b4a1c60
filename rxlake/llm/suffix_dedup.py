"""Suffix-array dedup: bytes covered by a string of ``WIDTH`` bytes that also
starts elsewhere, in the whole corpus.

Every window of WIDTH bytes has an anchor: the K-gram in it of least hash. Equal
windows have equal anchors at equal places, so they meet by anchor. Successive
windows with the same anchor form one segment of a text.

1. Segments are counted by anchor. An anchor found once holds no repeat.
2. Where equal segments are found (copies), all their windows repeat.
3. Other segments with a common anchor differ somewhere. Their strings, each
   distinct one once, go to collections by anchor, aligned at it, and in each the
   Burrows-Wheeler transform of the collection and the common prefixes are built
   column by column (``bwt``): windows with WIDTH bytes in common with a neighbour
   repeat.
   The segments of an anchor with more than ``MOST`` distinct ones are cut into
   pieces by where their windows begin (``RANGES`` of columns), and pieces are dealt
   by hash of the bytes that all their windows have in common; what is still more
   than ``MOST`` is cut into single windows. Dealing by hash only brings equal
   strings together; the transform compares their bytes.

Texts that occur twice as a whole are found by their digest first and given to
step 1 once a task.

Defined cases: null or empty text has no bytes; a text shorter than WIDTH keeps
all; repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.bwt import repeated_starts
from rxlake.llm.store import free_name, keep, schema_of, ship_code
from rxlake.llm.textkit import BYTE_VALUES, PLACE, mix, powers, prefix_sums, span_hash, text_slices

WIDTH = 200
K = 40
#: Distinct strings of one deal that a collection takes whole, and the ranges of
#: columns into which larger ones are cut, the last into single columns.
MOST = 4096
RANGES = (8, WIDTH - K + 1)
#: Parts of an anchor in joins.
SALTS = 8
#: Strings of a collection, about.
COLLECTION = 3000


def segments(buf: np.ndarray, offs: np.ndarray, width: int = WIDTH, k: int = K) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first start, last start, anchor's
    place, anchor hash, segment hash. Places are those in ``buf``."""
    span = width - k + 1  # K-grams in a window
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if len(buf) < width:
        return none
    sums = prefix_sums(buf, BYTE_VALUES)
    h = mix((sums[k:] - sums[:-k]) * powers(len(sums))[1][: len(sums) - k])
    low, reach = h, 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    text = np.flatnonzero(np.diff(offs) >= width)
    if not len(text):
        return none
    begin, final = offs[text], offs[text + 1] - width
    edge = np.zeros(len(low) + 1, np.int8)
    edge[begin] += 1
    edge[final + 1] -= 1
    valid = np.cumsum(edge[:-1]) > 0
    change = valid.copy()
    change[1:] &= low[1:] != low[:-1]
    change[begin] = True
    a = np.flatnonzero(change)
    owner = text[np.searchsorted(begin, a, "right") - 1]
    z = np.minimum(np.append(a[1:], len(low)) - 1, offs[owner + 1] - width)
    # The least K-gram came in at the window's end, or must be looked for.
    p = a + span - 1
    look = np.ones(len(a), bool)
    inner = a > offs[owner]
    look[inner] = low[a[inner]] >= low[a[inner] - 1]
    rows = np.flatnonzero(look)
    for lo in range(0, len(rows), 4096):
        r = rows[lo : lo + 4096]
        p[r] = a[r] + np.argmin(h[a[r][:, None] + np.arange(span)], axis=1)
    # In periodic text the least K-gram comes again while the run goes on.
    again = np.flatnonzero(z > p)
    if len(again):
        more = [[], [], [], []]
        for r in again:
            occ = a[r] + np.flatnonzero(h[a[r] : z[r] + span] == low[a[r]])
            first = np.append(a[r], occ[:-1] + 1)
            ok = first <= z[r]
            for out, x in zip(more, (np.full(ok.sum(), owner[r]), first[ok], np.minimum(occ, z[r])[ok], occ[ok]), strict=True):
                out.append(x)
        rest = np.ones(len(a), bool)
        rest[again] = False
        owner, a, z, p = (np.concatenate([x[rest], *m]) for x, m in zip((owner, a, z, p), more, strict=True))
    segment = mix(span_hash(sums, a, z + width) + (p - a).astype(np.uint64) * PLACE[60])
    return owner, a, z, p, h[p], segment


def _sketch(docs: DataFrame) -> DataFrame:
    """One row a text: rid, key (digest), n_bytes, and its segments unless the
    same task has given those of an equal text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, seen = TaskContext.get().partitionId() << 33, set()
        for b in batches:
            for lo, hi, buf, offs in text_slices(b, "text", 2 << 20):
                if len(seen) > 500_000:
                    seen.clear()
                raw, n = buf.tobytes(), hi - lo
                keys = [hashlib.md5(raw[offs[i] : offs[i + 1]]).digest() for i in range(n)]
                fresh = np.zeros(n, bool)
                for i, key in enumerate(keys):
                    fresh[i] = key not in seen
                    seen.add(key)
                owner, a, z, p, anchor, segment = segments(buf, offs)
                ok = fresh[owner] if len(owner) else np.zeros(0, bool)
                order = np.flatnonzero(ok)
                order = order[np.argsort(owner[order], kind="stable")]
                own = owner[order]
                at = pa.array(np.append(0, np.cumsum(np.bincount(own, minlength=n))).astype(np.int32))
                flat = pa.StructArray.from_arrays(
                    [pa.array(anchor[order].view(np.int64)), pa.array(segment[order].view(np.int64)), pa.array((a[order] - offs[own]).astype(np.int32)), pa.array((z - a + 1)[order].astype(np.int32)), pa.array((p - a)[order].astype(np.int32))],
                    ["anchor", "segment", "start", "n", "lead"],
                )
                yield pa.RecordBatch.from_arrays([pa.array(rid + np.arange(n)), pa.array(keys, pa.binary()), pa.array(np.diff(offs)), pa.ListArray.from_arrays(at, flat)], ["rid", "key", "n_bytes", "segments"])
                rid += n

    return docs.select("text").mapInArrow(run, "rid bigint, key binary, n_bytes bigint, segments array<struct<anchor:bigint,segment:bigint,start:int,n:int,lead:int>>")


def _strings(found: DataFrame, ranges: int) -> DataFrame:
    """Pieces of wanted segments: anchor, segment, nth (place of the first window in
    its segment), lead (the anchor's place in the piece), core (hash of the range of
    columns and of the bytes that all windows of the piece share), string. ``found``:
    text, wanted: array of (anchor, segment, start, n, lead)."""
    columns = WIDTH - K + 1
    # Windows that begin ``edges[r]`` to ``edges[r + 1]`` bytes before the anchor.
    edges = np.linspace(0, columns, ranges + 1).astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, wanted = b.column(0), b.column(1)
            for i in range(b.num_rows):
                raw = texts[i].as_py().encode()
                rows = []
                for w in wanted[i].as_py():
                    for r in range(ranges):
                        lo = max(0, w["lead"] - int(edges[r + 1]) + 1)
                        hi = min(w["n"], w["lead"] - int(edges[r]) + 1)
                        if lo >= hi:
                            continue
                        at = w["start"] + lo
                        piece = raw[at : w["start"] + hi - 1 + WIDTH]
                        # The last column of the range to the end of its first window.
                        place = w["start"] + w["lead"]
                        core = raw[place - int(edges[r]) : place - int(edges[r + 1]) + 1 + WIDTH] if ranges > 1 else b""
                        rows.append((w["anchor"], w["segment"], lo, w["lead"] - lo, int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=r.to_bytes(8, "little")).digest(), "little", signed=True), piece))
                cols = list(zip(*rows, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["anchor", "segment", "nth", "lead", "core", "string"])

    return found.select("text", "wanted").mapInArrow(run, "anchor bigint, segment bigint, nth bigint, lead bigint, core bigint, string binary")


def _collection(part: pa.Table) -> pa.Table:
    """The windows of one collection that repeat: anchor, segment, lo, hi (first
    and last place in the segment of each run of such windows). Pieces of one
    collection that do not belong together are aligned by anchor, so only equal
    windows at equal places meet."""
    marks = repeated_starts([s.as_py() for s in part.column("string")], -part.column("lead").to_numpy(), WIDTH)
    row, lo, hi = [], [], []
    for i, m in enumerate(marks):
        step = np.diff(np.concatenate([[0], m.view(np.int8), [0]]))
        lo.append(np.flatnonzero(step == 1))
        hi.append(np.flatnonzero(step == -1) - 1)
        row.append(np.full(len(lo[-1]), i))
    take = np.concatenate(row) if row else np.zeros(0, np.int64)
    cols = {c: part.column(c).take(pa.array(take)) for c in ("anchor", "segment")}
    nth = part.column("nth").take(pa.array(take)).to_numpy()
    return pa.table(cols | {"lo": (np.concatenate(lo) + nth).astype(np.int32), "hi": (np.concatenate(hi) + nth).astype(np.int32)})


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """By text digest: spans (array of (lo, hi), byte ranges that repeat); and
    the digests of texts that occur more than once."""
    ship_code(docs.sparkSession)
    rows = keep(_sketch(docs), "segments")
    copies = keep(rows.where(F.col("n_bytes") >= WIDTH).groupBy("key").count().where("count > 1").select("key"), "copies")
    each = rows.select("rid", F.inline("segments"))
    twice = each.groupBy("anchor").agg(F.count("*").alias("c"), F.min("segment").alias("s0"), F.max("segment").alias("s1")).where("c > 1")
    # A hot anchor meets its texts in parts.
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")
    twice = twice.select("anchor", (F.col("s0") == F.col("s1")).alias("alike"), F.explode(salts).alias("salt"))
    each = each.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
    each = keep(each.join(twice, ["anchor", "salt"]).drop("salt"), "shared")
    mixed = each.where("NOT alike").groupBy("anchor", "segment").agg(F.count("*").alias("c"), F.min(F.struct("rid", "start", "n", "lead")).alias("rep"))
    mixed = keep(mixed, "mixed")
    known = rows.select("rid", "key")

    def pieces(wanted: DataFrame, ranges: int) -> DataFrame:
        """Strings of ``wanted`` (of ``mixed``), each distinct segment once."""
        want = wanted.select(F.col("rep.rid").alias("rid"), F.struct("anchor", "segment", F.col("rep.start").alias("start"), F.col("rep.n").alias("n"), F.col("rep.lead").alias("lead")).alias("w"))
        want = keep(want.groupBy("rid").agg(F.collect_list("w").alias("wanted")).join(known, "rid").select("key", "wanted"), "wanted")
        texts = docs.select("text", F.unhex(F.md5("text")).alias("key")).join(want, "key")
        return _strings(texts, ranges).dropDuplicates(["anchor", "segment", "nth"])

    def collected(strings: DataFrame, total: int) -> DataFrame:
        """Runs of repeated windows of strings, dealt by anchor and core."""
        dealt = strings.withColumn("deal", F.pmod(F.xxhash64("anchor", "core"), F.lit(max(1, -(-total // COLLECTION)))))
        return dealt.groupBy("deal").applyInArrow(_collection, "anchor bigint, segment bigint, lo int, hi int")

    kinds = mixed.groupBy("anchor").agg(F.count("*").alias("kinds"))
    large = keep(kinds.where(F.col("kinds") > MOST).select("anchor"), "large")
    small = mixed.join(large, "anchor", "left_anti")
    found = [collected(pieces(small, 1), small.count())]
    if not large.isEmpty():
        rest = mixed.join(large, "anchor", "left_semi")
        for ranges in RANGES:
            cut = keep(pieces(rest, ranges), "pieces")
            # Equal pieces are one string of their collection, whatever their segments.
            sizes = cut.groupBy("anchor", "core").agg(F.count("*").alias("kinds"))
            over = sizes.where(F.col("kinds") > (MOST if ranges < RANGES[-1] else 1 << 62)).select("anchor", "core")
            over = keep(over, "over")
            fine = cut.join(over, ["anchor", "core"], "left_anti")
            if ranges == RANGES[-1]:
                # Single windows: with its core equal, a window is equal as a whole.
                again = fine.groupBy("anchor", "string").agg(F.count("*").alias("c")).where("c > 1").drop("c")
                found.append(fine.join(again, ["anchor", "string"]).select("anchor", "segment", F.col("nth").cast("int").alias("lo"), F.col("nth").cast("int").alias("hi")))
                break
            found.append(collected(fine, fine.count()))
            rest = rest.join(cut.join(over, ["anchor", "core"], "left_semi").select("anchor", "segment").distinct(), ["anchor", "segment"], "left_semi")
            if over.isEmpty():
                break
    found = keep(reduce(DataFrame.union, found), "runs")
    # Segments found once take the runs; those found again repeat as a whole.
    single = each.where("NOT alike").join(mixed.where("c = 1").select("anchor", "segment"), ["anchor", "segment"])
    part = single.join(found, ["anchor", "segment"]).select("rid", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + WIDTH).alias("hi"))
    multiple = each.where("NOT alike").join(mixed.where("c > 1").select("anchor", "segment"), ["anchor", "segment"]).select("rid", "start", "n")
    full = each.where("alike").select("rid", "start", "n").union(multiple).select("rid", F.col("start").alias("lo"), (F.col("start") + F.col("n") - 1 + WIDTH).alias("hi"))
    spans = full.union(part).groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")).join(known, "rid")
    spans = spans.join(copies, "key", "left_anti").groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return keep(spans, "spans"), copies


def removed(docs: DataFrame, columns: list[str], *, with_text: bool = False) -> DataFrame:
    """``columns`` and n_bytes, n_removed, n_spans, kept_sha256 of each text
    without its repeated bytes; with_text: also ``kept`` (binary)."""
    spans, copies = repeats(docs)
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    own = [c for c in columns if c not in made]
    text, key, found, whole = free_name(docs.select(*own), "_text", "_key", "_spans", "_whole")
    rows = docs.select(*own, F.col("text").alias(text), F.unhex(F.md5("text")).alias(key))
    marks = spans.select("key", "spans", F.lit(False).alias("whole")).unionByName(copies.select("key", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), F.lit(True).alias("whole")))
    marks = marks.select(F.col("key").alias(key), F.col("spans").alias(found), F.col("whole").alias(whole))
    rows = rows.join(marks, key, "left").select(*own, text, found, whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = len(own)
            for lo in range(0, batch.num_rows, 500):
                b = batch.slice(lo, 500)
                out = []
                for t, s, w in zip(b.column(k), b.column(k + 1), b.column(k + 2), strict=True):
                    out.append(_cut((t.as_py() or "").encode(), s.values if s.is_valid else None, bool(w.as_py())))
                cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
                cols.append(pa.array([hashlib.sha256(r[3]).hexdigest() for r in out]))
                if with_text:
                    cols.append(pa.array([r[3] for r in out], pa.binary()))
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(k)] + cols, [*own, *made])

    kinds = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return rows.mapInArrow(run, schema_of(docs.select(*own), kinds))


def _cut(raw: bytes, spans: pa.StructArray | None, whole: bool) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed runs, kept bytes."""
    if whole:
        return len(raw), len(raw), 1, b""
    if spans is None or not len(spans):
        return len(raw), 0, 0, raw
    step = np.zeros(len(raw) + 1, np.int64)
    np.add.at(step, spans.field("lo").to_numpy(), 1)
    np.add.at(step, spans.field("hi").to_numpy(), -1)
    gone = np.cumsum(step[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()
