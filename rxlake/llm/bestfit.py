"""Best-fit packing with certified bin counts.

A document of more than ``length`` tokens is cut into full pieces, each a sequence
of its own, and a shorter first piece; first pieces and shorter documents are the
items. Items are dealt out over partitions by hash and packed there best-fit
decreasing. Dual feasible functions of the sizes give each partition a lower bound;
one whose count equals it is certified: no packing of its items has fewer bins.

Bins are whole but bounds are not: a partition whose count exceeds its bound before
rounding has a gap that it may close together with others. Such partitions exchange
documents: an uncertified one gives all its bins that are not full, a certified one
its loosest. What they give is dealt anew over as few partitions as hold it and
packed again, while that saves bins and the total is above the bound of all items.

Defined cases: null or empty text is the end id alone; repeated rows are packed as
often as they come; equal sizes go by place of input; an empty table gives no
pieces; columns of the input are kept but those named as a result column.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.encode import encoder
from rxlake.llm.packing import encode_documents
from rxlake.llm.store import free_name, keep, schema_of

LENGTH = 1024
END = 2
#: Items that are packed together.
DEALT = 16384
#: Exchanges at most.
ROUNDS = 8
#: Divisors of the rounding functions.
DIVISORS = 32

MADE = ["piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset", "certified"]


def lower_bound(count: np.ndarray) -> tuple[int, int]:
    """The largest of the dual feasible bounds, as a fraction, on the bins for
    ``count[x]`` items of each size x up to the capacity ``len(count) - 1``.

    For each t up to half the capacity: sizes below t count nothing, those above
    capacity - t a bin. For each divisor k: sizes that are no multiple of
    capacity / (k + 1) are rounded down to a multiple of capacity / k."""
    count = count.astype(np.int64)
    full = len(count) - 1
    size = np.arange(full + 1)
    items, volume = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(0, full // 2 + 1)
    below = np.where(t > 0, volume[np.maximum(t - 1, 0)], 0)
    best, under = int(((items[-1] - items[full - t]) * full + volume[full - t] - below).max()), full
    for k in range(1, DIVISORS + 1):
        scaled = np.where((k + 1) * size % full == 0, size * k, (k + 1) * size // full * full)
        value = int((scaled * count).sum())
        if value * under > best * full * k:
            best, under = value, full * k
    return best, under


def best_fit_decreasing(size: np.ndarray, full: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and its place there; ``size`` falls. The fullest bin with
    room is found by the lowest set bit of a mask of the rooms that exist."""
    bins, at = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(full + 1)]
    rooms, made = 0, 0
    for i, s in enumerate(size.tolist()):
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = full, made
            made += 1
        bins[i], at[i] = b, full - room
        left = room - s
        if left:
            if not open_bins[left]:
                rooms |= 1 << left
            open_bins[left].append(b)
    return bins, at


def pack_round(pool: DataFrame, turn: int, parts: int, length: int) -> DataFrame:
    """``pool`` (pid, before, size) packed by partition: part, bin, offset, whether
    the count is certified, whether the item's bin is given away, its first item."""

    def run(group: pa.Table) -> pa.Table:
        pid, before, size, part = (group.column(c).to_numpy() for c in ("pid", "before", "size", "part"))
        order = np.lexsort((before, pid, -size))
        pid, before, size = pid[order], before[order], size[order]
        bins, at = best_fit_decreasing(size, length)
        used = np.bincount(bins, size).astype(np.int64)
        value, under = lower_bound(np.bincount(size, minlength=length + 1))
        certified = len(used) == -(-value // under)
        given = used < length
        if certified:
            loosest = np.arange(len(used)) == int(np.argmin(used))
            given &= loosest & (len(used) * under > value)
        n = len(size)
        cols = {"pid": pid, "before": before, "size": size, "part": part[:n], "bin": bins, "offset": at, "certified": np.full(n, certified), "given": given[bins], "opens": at == 0}
        return pa.table({c: pa.array(v) for c, v in cols.items()})

    dealt = pool.withColumn("part", F.pmod(F.xxhash64("pid", "before", F.lit(turn)), F.lit(parts)))
    schema = "pid bigint, before bigint, size bigint, part bigint, bin bigint, offset bigint, certified boolean, given boolean, opens boolean"
    return keep(dealt.groupBy("part").applyInArrow(run, schema), "packed")


@dataclass
class Certificate:
    """Sequences used for the items, and a lower bound on any packing of them."""

    sequences: int
    bound: int
    exchanges: int


def place_items(items: DataFrame, length: int, dealt: int = DEALT, rounds: int = ROUNDS) -> tuple[DataFrame, Certificate]:
    """pid, before, sequence_id, offset, certified of all items."""
    sizes = items.groupBy("size").agg(F.count("*").alias("n")).collect()  # at most ``length`` rows
    count = np.zeros(length + 1, np.int64)
    for row in sizes:
        count[row["size"]] = row["n"]
    value, under = lower_bound(count)
    bound, pool_size = -(-value // under), int(count.sum())
    pool, used, done, total = items, None, [], 0
    for turn in range(rounds + 1):
        tried = pack_round(pool, turn, max(1, -(-pool_size // dealt)), length)
        made = F.count_if("opens")
        row = tried.agg(made.alias("bins"), F.count_if(F.col("opens") & F.col("given")).alias("given"), F.count_if("given").alias("items")).first()
        if used is not None and row["bins"] >= used:
            break
        total += row["bins"] - (used or 0)
        done.append(tried.withColumn("sequence_id", F.lit(turn * 2**56) + F.col("part") * 2**24 + F.col("bin")))
        if total <= bound or row["given"] < 2:
            break
        pool, used, pool_size = tried.where("given").select("pid", "before", "size"), row["given"], row["items"]
    out = ["pid", "before", "sequence_id", "offset", "certified"]
    placed = done[-1].select(*out)
    for earlier in done[:-1]:
        placed = placed.union(earlier.where(~F.col("given")).select(*out))
    return placed, Certificate(total, bound, len(done) - 1)


def pack(docs: DataFrame, path: str, columns: list[str], *, length: int = LENGTH, end: int = END, with_ids: bool = True, dealt: int = DEALT) -> tuple[DataFrame, Certificate]:
    """Pieces (``columns``, piece, start, length, ids if asked for, ids_crc32,
    sequence_id, offset, certified) and the certificate of the items' packing."""
    kept, (ids, n, pid, before) = encode_documents(docs, path, columns, end)
    own = [c for c in columns if c not in MADE]
    rest = F.col(n) % length
    items = kept.where(rest > 0).select(F.col(pid).alias("pid"), F.col(before).alias("before"), rest.alias("size"))
    placed, certificate = place_items(items, length, dealt)
    names = free_name(docs.select(*own), "_own_pid", "_own_before")
    k = len(own)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = encoder(path).wide
        for batch in batches:
            for b in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                data = b.column(k).to_pylist()
                size, p, at = (b.column(k + j).to_numpy() for j in (1, 2, 3))
                first = size % length
                pieces = size // length + (first > 0)
                row = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.where(first[row] > 0, np.maximum(first[row] + (piece - 1) * length, 0), piece * length)
                long = np.where((piece == 0) & (first[row] > 0), first[row], length)
                parts = [np.frombuffer(data[r], wide)[s : s + m].astype("<u4").tobytes() for r, s, m in zip(row, start, long, strict=True)]
                alone = long == length
                sequence = pa.array(-1 - ((p[row] << 40) + at[row] + start), mask=~alone)
                cols = [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(long), *([pa.array(parts, pa.binary())] if with_ids else []), pa.array([zlib.crc32(x) for x in parts], pa.int64()), sequence, pa.array(p[row]), pa.array(at[row])]
                yield pa.RecordBatch.from_arrays([b.column(i).take(pa.array(row)) for i in range(k)] + cols, [*own, *made, *names])

    made = ["piece", "start", "length", *(["ids"] if with_ids else []), "ids_crc32", "sequence_id"]
    kinds = {"piece": "int", "ids": "binary"}
    schema = schema_of(docs.select(*own), ", ".join(f"`{c}` {kinds.get(c, 'bigint')}" for c in [*made, *names]))
    pieces = kept.select(*own, ids, n, pid, before).mapInArrow(cut, schema)
    # Full pieces are placed; the others meet their places by partition and place.
    alone = pieces.where(F.col("sequence_id").isNotNull()).drop(*names).withColumns({"offset": F.lit(0).cast("long"), "certified": F.lit(True)})
    short = pieces.where(F.col("sequence_id").isNull()).drop("sequence_id")
    placed = placed.withColumnsRenamed({"pid": names[0], "before": names[1]})
    short = short.join(placed, names).drop(*names)
    return short.select(*alone.columns).union(alone), certificate
