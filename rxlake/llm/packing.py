"""Packing: concatenate and cut.

Pass one encodes each text once and keeps its ids with the input partition and
the tokens before it there. The partitions' totals give each partition's global
offset (prefix sums). Pass two cuts the stream at multiples of the length; a
window that spans two partitions is made of boundary records from both, which
``assemble`` joins by window number.

Defined cases: null or empty text is the end id alone; repeated rows are packed
as often as they come; ties cannot occur (the order is that of the input); an
empty table gives no pieces; the last sequence alone is short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.encode import encoder
from rxlake.llm.store import free_name, keep, prefix_of_totals, schema_of, ship_code
from rxlake.llm.textkit import text_slices

LENGTH = 2048
END = 1
MADE = ["start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset", "boundary"]


def encode_documents(docs: DataFrame, path: str, columns: list[str], end: int = END) -> tuple[DataFrame, list[str]]:
    """The kept table: ``columns``, ids (binary, little-endian), tokens,
    partition, tokens before it in that partition. Second: the added names."""
    ship_code(docs.sparkSession)
    text, *added = free_name(docs.select(*columns), "_text", "_ids", "_n", "_pid", "_before")
    rows = docs.select(*columns, F.col("text").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pid, before = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, buf, offs in text_slices(batch, text, 2 << 20):
                ids, by_text = enc.encode(buf, offs)
                ids = np.insert(ids, by_text[1:], enc.wide(end))
                at = by_text + np.arange(len(by_text))
                n = np.diff(at)
                data = ids.astype(np.dtype(enc.wide).newbyteorder("<"))
                blob = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((at * data.itemsize).astype(np.int32)), pa.py_buffer(data)])
                cols = [blob, pa.array(n), pa.array(np.full(len(n), pid, np.int64)), pa.array(before + at[:-1])]
                before += int(at[-1])
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(lo, hi - lo) for i in range(len(columns))] + cols, [*columns, *added])

    kind = dict(zip(added, ("binary", "bigint", "bigint", "bigint"), strict=True))
    schema = schema_of(docs.select(*columns), ", ".join(f"`{c}` {k}" for c, k in kind.items()))
    return keep(rows.mapInArrow(run, schema), "ids"), added


def pack(docs: DataFrame, path: str, columns: list[str], *, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """Pieces: ``columns``, start, length, ids (if asked for), ids_crc32,
    doc_tokens, sequence_id, offset, boundary (its window spans two partitions)."""
    kept, (ids, n, pid, before) = encode_documents(docs, path, columns, end)
    own = [c for c in columns if c not in MADE]
    totals = keep(kept.groupBy(pid).agg(F.sum(n).alias("total")), "totals")
    lo, first, last, total = free_name(kept, "_lo", "_first", "_last", "_total")
    starts = prefix_of_totals(totals, pid, ["total"]).join(totals, pid)
    starts = keep(starts.select(pid, F.col("before_total").alias(first), F.col("total").alias(total)), "starts")
    rows = kept.join(starts, pid)
    rows = rows.select(*own, ids, n, (F.col(first) + F.col(before)).alias(lo), first, (F.col(first) + F.col(total)).alias(last))
    width = ", ids binary" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = encoder(path).wide
        for batch in batches:
            for b in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                k = len(own)
                data = b.column(k).to_pylist()
                size, g0, p0, p1 = (b.column(k + j).to_numpy() for j in (1, 2, 3, 4))
                w0 = g0 // length
                count = (g0 + size - 1) // length - w0 + 1
                row = np.repeat(np.arange(len(size)), count)
                w = w0[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                a = np.maximum(w * length, g0[row])
                z = np.minimum((w + 1) * length, (g0 + size)[row])
                start = a - g0[row]
                cut = [np.frombuffer(data[r], wide)[s : s + m].astype("<u4").tobytes() for r, s, m in zip(row, start, z - a, strict=True)]
                cols = [pa.array(start), pa.array(z - a), *([pa.array(cut, pa.binary())] if with_ids else []), pa.array([zlib.crc32(x) for x in cut], pa.int64()), pa.array(size[row]), pa.array(w), pa.array(a - w * length), pa.array((w * length < p0[row]) | ((w + 1) * length > p1[row]))]
                take = pa.array(row)
                names = [*own, "start", "length", *(["ids"] if with_ids else []), "ids_crc32", "doc_tokens", "sequence_id", "offset", "boundary"]
                yield pa.RecordBatch.from_arrays([b.column(i).take(take) for i in range(k)] + cols, names)

    schema = schema_of(docs.select(*own), f"start bigint, length bigint{width}, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, boundary boolean")
    return rows.mapInArrow(run, schema)


def assemble(pieces: DataFrame) -> DataFrame:
    """Sequences from pieces with ids: sequence_id, ids (32-bit little-endian),
    tokens. A group holds one sequence, at most its length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("tokens"))
    whole = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return joined.select("sequence_id", whole.alias("ids"), "tokens")
