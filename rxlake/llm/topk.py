"""Exact top-k search by inner product: three phases with a uniform threshold.

A vector's components are dealt to ``m`` blocks of dimensions; each block holds
part of every score, and a score is the sum of its parts.

1. Each block gives, for each query, its list of highest partial scores. The
   scores of the entries found are resolved; the k-th best is a safe cutoff c:
   at least k candidates reach it.
2. A candidate with score >= c has a part >= c / m in some block. The cutoffs go
   to all blocks, which give every entry that reaches c / m (m * part >= c, in
   integers).
   An entry goes no further than its block if even with the most that the other
   dimensions can add (the product of the two vectors' norms there) it cannot
   reach c.
3. The other entries are resolved exactly, and the k best are taken.

Equal vectors are one class that carries its k + 1 smallest ids; among the k + 1
best ids of any query each belongs to one of the k + 1 best classes. So copies
cost nothing, however many there are.

Queries meet candidates in cells of bounded size: both lie in chunks, and every
chunk of queries is sent to every chunk of candidates. A task holds one chunk of
candidates, whose chunks of queries stream past; nothing is broadcast. A cell has all
blocks of its vectors, so an entry is resolved where it is found: no entry travels,
and a cell gives at most k + 1 classes a query. The pairs that are compared grow with
queries times candidates, what is moved with queries times chunks.

Defined cases: vectors that are null, or have a null or non-finite component,
and rows without id take no part; a repeated row counts once, and rows with the
query's id are the query's own; a shorter vector is filled with zeros; an empty
vector scores 0 with all; equal scores go to the smaller id; an empty table
gives no rows. Products are floating-point ones where those are exact, else 64-bit
integers, else Python's; a listed part or score beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rxlake.llm.store import keep, ship_code

#: Vectors in a chunk of queries, chunks of that size in one of candidates at most, queries
#: that are compared at once (all of their pairs may be entries), and blocks of dimensions.
CHUNK = 2048
FOLD = 8
AT_ONCE = 256
BLOCKS = 2


def quantised(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; null if the vector is
    null or has a component that is null or not finite."""
    x = F.transform(vec, lambda v: v.cast("double"))
    fine = vec.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def classes_of(vectors: DataFrame, k: int) -> DataFrame:
    """cid, v, ids: one row a distinct vector with its k + 1 smallest ids (cid:
    the smallest). A hot vector shrinks to k + 1 rows a task before the shuffle."""
    ids = vectors.select("vec_id", "v").where("vec_id IS NOT NULL AND v IS NOT NULL")
    first = ids.select("vec_id", "v", F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id")).alias("r")).where(F.col("r") <= k + 1)
    return first.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).select(F.col("ids")[0].alias("cid"), "v", "ids")


def _chunked(rows: DataFrame, dims: int, count: int) -> DataFrame:
    """Rows of ``count`` chunks: chunk, ids, vals (a matrix as binary, block after block,
    of the narrowest integers ``kind`` that hold it), rest (norms outside each block),
    cuts. The chunk of a row follows from a hash of its id, so chunks are of about one size."""
    cutoff = "cut" in rows.columns
    cols = ["cid", "v"] + (["cut"] if cutoff else [])
    dealt = rows.select((F.pmod(F.xxhash64("cid"), F.lit(count))).cast("long").alias("chunk"), *cols)

    def lay_out(part: pa.Table) -> pa.Table:
        matrix = np.zeros((part.num_rows, dims), np.int64)
        vectors = part.column("v").combine_chunks()
        size = vectors.value_lengths().to_numpy()
        row = np.repeat(np.arange(len(size)), size)
        matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = vectors.flatten().to_numpy()
        ids = part.column("cid").to_numpy().astype(np.int64).tobytes()
        cuts = (part.column("cut").to_numpy() if cutoff else np.zeros(len(size))).astype(np.int64).tobytes()
        kind = np.promote_types(*(np.min_scalar_type(min(int(x), -1)) for x in (matrix.min(initial=0), -1 - matrix.max(initial=0)))).str
        # Norms outside the block, summed there: no cancellation.
        square = matrix.astype(np.float64) ** 2
        rest = [np.sqrt(square[:, :lo].sum(1) + square[:, hi:].sum(1)) for lo, hi in _bounds(dims)]
        vals = b"".join(matrix[:, lo:hi].astype(kind).tobytes() for lo, hi in _bounds(dims))
        return pa.table({"chunk": [part.column("chunk")[0].as_py()], "ids": [ids], "kind": [kind], "vals": [vals], "rest": [np.concatenate(rest).tobytes()], "cuts": [cuts]})

    return dealt.groupBy("chunk").applyInArrow(lay_out, "chunk bigint, ids binary, kind string, vals binary, rest binary, cuts binary")


def _bounds(dims: int) -> list[tuple[int, int]]:
    """First dimension of each block, and the first beyond it."""
    width = -(-dims // BLOCKS)
    return [(min(j * width, dims), min((j + 1) * width, dims)) for j in range(BLOCKS)]


def _meet(queries: DataFrame, cands: DataFrame, count: int, dims: int, k: int, lists: bool) -> DataFrame:
    """qid, cid, score: for each query and chunk of candidates the k best scores (ties
    to the smaller cid) among the entries that blocks give: their lists of the k highest
    parts (``lists``), or all with BLOCKS * part >= the query's cutoff that can reach
    it at all and do."""
    # Each chunk of queries goes to every chunk of candidates, and comes after it.
    spread = queries.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<int>")))
    cells = cands.withColumn("_at", F.col("chunk").cast("int")).withColumn("chunk", F.lit(-1).cast("long")).unionByName(spread)
    cells = cells.repartitionById(count, "_at").sortWithinPartitions("_at", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = None
        for b in batches:
            for row in b.to_pylist():
                ids, side = np.frombuffer(row["ids"], np.int64), _blocks_of(row, dims)
                if row["chunk"] < 0:
                    c, at = (ids, *side), row["_at"]
                elif c is not None and row["_at"] == at:
                    cuts = np.frombuffer(row["cuts"], np.int64)
                    for lo in range(0, len(ids), AT_ONCE):
                        few = slice(lo, lo + AT_ONCE)
                        q = (ids[few], *([x[few] for x in y] for y in side))
                        found = _lists(q, c, k) if lists else _reaching(q, c, cuts[few], k)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["qid", "cid", "score"])

    return cells.mapInArrow(run, "qid bigint, cid bigint, score bigint")


def _blocks_of(row: dict, dims: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The matrix and the outside norms of each block of a chunk."""
    n, kind, at, blocks = len(row["ids"]) // 8, np.dtype(row["kind"]), 0, []
    for lo, hi in _bounds(dims):
        blocks.append(np.frombuffer(row["vals"], kind, n * (hi - lo), at).reshape(n, hi - lo))
        at += n * (hi - lo) * kind.itemsize
    return blocks, list(np.frombuffer(row["rest"]).reshape(BLOCKS, n))


def _tiles(q: tuple, c: tuple) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """The parts of all pairs by block, for CHUNK candidates at a time."""
    for lo in range(0, len(c[0]), CHUNK):
        tile = slice(lo, lo + CHUNK)
        yield tile, [_exact(a, b[tile]) for a, b in zip(q[1], c[1], strict=True)]


def _sum(parts: list[np.ndarray], at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Scores of the pairs at some places; an error where they exceed 64 bits."""
    large = any(p.dtype == object for p in parts)
    found = [p[at] if p.dtype == object else p[at].astype(np.int64) for p in parts]
    return sum(x.astype(object) for x in found).astype(np.int64) if large else sum(found)


def _best(rows: np.ndarray, cids: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest values of each row, ties to the smaller cid."""
    order = np.lexsort((cids, ~values, rows))
    start = np.searchsorted(rows[order], rows[order])
    return order[np.arange(len(order)) - start < k]


def _lists(q: tuple, c: tuple, k: int) -> tuple[np.ndarray, ...]:
    held = [[np.zeros(0, np.int64)] * 4 for _ in range(BLOCKS)]
    least: list = [None] * BLOCKS
    for tile, parts in _tiles(q, c):
        cids = c[0][tile]
        for j, part in enumerate(parts):
            if least[j] is None and part.shape[1] > k:
                top = np.argpartition(part, part.shape[1] - k, axis=1)[:, -k:]
                at = np.repeat(np.arange(len(top)), k), top.ravel()
            else:
                at = np.nonzero(np.ones(part.shape, bool) if least[j] is None else part > least[j][:, None].astype(part.dtype))
            new = [at[0], cids[at[1]], _sum([part], at), _sum(parts, at)]
            held[j] = [np.concatenate(x) for x in zip(held[j], new, strict=True)]
            kept = _best(held[j][0], held[j][1], held[j][2], k)
            held[j] = [x[kept] for x in held[j]]
            if len(kept) == k * len(q[0]):
                least[j] = held[j][2].reshape(-1, k)[:, -1]
    rows, cids, _, score = (np.concatenate(x) for x in zip(*held, strict=True))
    one = np.unique(np.stack([rows, cids]), axis=1, return_index=True)[1]
    rows, cids, score = rows[one], cids[one], score[one]
    kept = _best(rows, cids, score, k)
    return q[0][rows[kept]], cids[kept], score[kept]


def _reaching(q: tuple, c: tuple, cuts: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    need = -(-cuts // BLOCKS)
    found = [np.zeros(0, np.int64)] * 3
    for tile, parts in _tiles(q, c):
        reach = [part >= need[:, None].astype(part.dtype) for part in parts]
        for j, part in enumerate(parts):
            # What an earlier block gives is resolved there.
            at = np.nonzero(reach[j] & ~np.logical_or.reduce(reach[:j]) if j else reach[j])
            # Rounded up by more than the errors of norms and of large integers as doubles.
            own, cut = part[at].astype(np.float64), cuts[at[0]].astype(np.float64)
            most = q[2][j][at[0]] * c[2][j][tile][at[1]] * (1 + 1e-9) + 1
            able = own + most + 1e-15 * (np.abs(own) + most + np.abs(cut)) >= cut
            at = at[0][able], at[1][able]
            score = _sum(parts, at)
            good = score >= cuts[at[0]]
            new = [at[0][good], c[0][tile][at[1][good]], score[good]]
            found = [np.concatenate(x) for x in zip(found, new, strict=True)]
        kept = _best(*found, k)
        found = [x[kept] for x in found]
    rows, cids, score = found
    return q[0][rows], cids, score


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, in the narrowest type
    that holds them and all their sums."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) * a.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64 if most * BLOCKS < 2**62 else object
    return a.astype(kind) @ b.astype(kind).T


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices."""
    return _exact(a, b).astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. ``vectors``: vec_id and v (array
    of long, null for a vector that takes no part)."""
    ship_code(vectors.sparkSession)
    classes = keep(classes_of(vectors, k), "classes")
    asked = vectors.where("v IS NOT NULL AND vec_id IS NOT NULL").where(is_query).select("vec_id", "v").distinct()
    # Stored vectors take several times the length of their files; the planner goes by
    # that, so it is told not to broadcast them.
    asked = keep(asked.join(classes.select("v", "cid").hint("merge"), "v").select(F.col("vec_id").alias("query_id"), F.col("cid").alias("qid")), "asked")
    heads = keep(classes.join(asked.select(F.col("qid").alias("cid")).distinct(), "cid", "left_semi").select("cid", "v"), "heads")
    size = classes.agg(F.max(F.size("v")).alias("dims"), F.count("*").alias("n")).first()
    dims, n = int(size["dims"] or 0), size["n"]
    count = max(1, -(-n // (CHUNK * FOLD)), min(-(-n // CHUNK), 2 * vectors.sparkSession.sparkContext.defaultParallelism))
    cands = keep(_chunked(classes, dims, count), "cchunks")
    groups = max(1, -(-heads.count() // CHUNK))
    most = k + 1
    # Phase 1: local lists, resolved; the cutoff is the k-th best known score.
    known = _meet(_chunked(heads, dims, groups), cands, count, dims, most, True)
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")
    ranked = known.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)
    cut = keep(ranked.groupBy("qid").agg(F.count("*").alias("n"), F.min("score").alias("least")).select(F.col("qid").alias("cid"), F.when(F.col("n") == most, F.col("least")).alias("cut")), "cuts")
    # Phases 2 and 3: every entry that reaches cut / m, resolved. Fewer candidates than asked for: all.
    floor = F.lit(-(2**63) + 2)
    heads = heads.hint("merge").join(cut, "cid").select("cid", "v", F.coalesce("cut", floor).alias("cut"))
    found = _meet(_chunked(heads, dims, groups), cands, count, dims, most, False)
    found = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("qid", "cid", "score")
    spread = asked.join(found, "qid").join(classes.select("cid", "ids"), "cid").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return spread.distinct().withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
