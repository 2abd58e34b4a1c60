"""Parallel scan of RFC 4180 text: quoted fields may hold line breaks, and files
are split all the same.

A file is read as physical lines over byte ranges (blocks). Whether a line begins a
record depends on whether a quoted field is open where it begins, so

1. each block tells, for either state at its start, the state at its end, how many
   records begin in it, and the text of those that reach over its start or end: a map
   of two states, one row a block;
2. running windows over a file's blocks compose the maps: the state at the start of
   each block, and the last block before it in which a record begins;
3. with that, each block cuts its lines into records on its own. A record over the
   end of a block left a fragment in each block that it touches; fragments meet
   by the block in which their record begins.

So lines are read twice. What lines do to the state is found by regular expressions
over a batch, and composed like the maps of blocks.

Records are then parsed by ``from_csv`` with the header of their file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rxlake.session import ship_code, stored

#: One field that ends in its line, with its delimiter.
_FIELD = re.compile(r'(?:"(?:[^"]|"")*+"[^,]*|(?!")[^,]*)(,|\Z)')
#: The rest of an open field that ends in its line.
_CLOSE = re.compile(r'(?:[^"]|"")*+"[^,]*(,|\Z)')


def open_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line. A quote opens a field only
    as its first character; elsewhere in a bare field it is text."""
    at = 0
    if inside:
        closed = _CLOSE.match(line)
        if not closed:
            return True
        if not closed[1]:
            return False
        at = closed.end()
    while True:
        field = _FIELD.match(line, at)
        if not field:
            return True
        if not field[1]:
            return False
        at = field.end()


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with one file and block each."""
    file, block = (batch.column(i).to_numpy() for i in (0, 1))
    edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for lo, hi in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


# Fields that all end in their line, up to its end; and those after an open one's rest.
# After a closing quote comes no quote, so there is one way to match.
_QUOTED = r'(?:[^"]|"")*"(?:[^",][^,]*)?'
_ANY = rf'(?:"{_QUOTED}|(?:[^",][^,]*)?)'
_CLOSED = rf"^{_ANY}(?:,{_ANY})*\z"
_CLOSED_INSIDE = rf"^{_QUOTED}(?:,{_ANY})*\z"


def open_ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``open_after`` of each line, with no field open before it and with one."""
    text = lines.cast(pa.binary())
    return tuple(~pc.match_substring_regex(text, p).to_numpy(zero_copy_only=False).astype(bool) for p in (_CLOSED, _CLOSED_INSIDE))


class _Lines:
    """Some lines of one block, and what those with quotes do to the state."""

    def __init__(self, value: pa.Array):
        self.value = value
        quoted = pc.match_substring(value, '"').to_numpy(zero_copy_only=False).astype(bool)
        self.before = np.cumsum(quoted) - quoted  # quoted lines ahead of each
        self.out, self.inn = open_ends(value.filter(pa.array(quoted)))

    def walk(self, inside: bool) -> tuple[np.ndarray, bool]:
        """Places of lines that begin a record, and the state after all."""
        n = len(self.out)
        fixed = np.maximum.accumulate(np.where(self.out == self.inn, np.arange(n), -1))
        swaps = np.cumsum(self.out & ~self.inn)
        # The state that the last fixing line left, turned by each swap since.
        left = np.where(fixed >= 0, self.out[fixed], inside) if n else np.zeros(0, bool)
        since = swaps - np.where(fixed >= 0, swaps[fixed], 0) if n else swaps
        state = np.append(inside, left ^ (since % 2 == 1)).astype(bool)
        return np.flatnonzero(~state[self.before]), bool(state[-1])

    def texts(self, lo: int, hi: int | None = None) -> list[str]:
        return self.value.slice(lo, None if hi is None else hi - lo).to_pylist()


class _Side:
    """A block read from one state on: its records' number, and the lines of its first
    record, of what comes before that, and of its last record."""

    def __init__(self, inside: bool):
        self.inside, self.starts, self.head, self.first, self.last = inside, 0, [], [], []

    def go(self, lines: _Lines) -> None:
        begins, self.inside = lines.walk(self.inside)
        lead = lines.texts(0, int(begins[0]) if len(begins) else None)
        if not self.starts:
            self.head += lead
        elif self.starts == 1:
            self.first += lead
        if len(begins):
            if not self.starts:
                self.first = lines.texts(int(begins[0]), int(begins[1]) if len(begins) > 1 else None)
            self.last = lines.texts(int(begins[-1]))
        elif self.starts:
            self.last += lead
        self.starts += len(begins)

    def tail(self) -> str | None:
        return "\n".join(self.last) if self.inside and self.starts else None


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """file (a hash of its path), block (its first byte), value, line (rising)."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("line")
    )


def block_maps(lines: DataFrame) -> DataFrame:
    """file, block, end0, end1 (a field open at the end, if none or one was at the
    start), starts0, starts1 (records that begin), head (lines before the first record,
    if a field was open), tail0, tail1 (the record that reaches over the end), top (the
    first record of a file, as far as it is here)."""
    kinds = {"file": pa.int64(), "block": pa.int64(), "end0": pa.bool_(), "end1": pa.bool_(), "starts0": pa.int64(), "starts1": pa.int64(), "head": pa.string(), "tail0": pa.string(), "tail1": pa.string(), "top": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, ()

        def row() -> pa.RecordBatch:
            a, b = sides
            top = "\n".join(a.first) if now[1] == 0 else None
            cells = (*now, a.inside, b.inside, a.starts, b.starts, "\n".join(b.head), a.tail(), b.tail(), top)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, kinds.values(), strict=True)], list(kinds))

        for batch in batches:
            for part in _runs(batch):
                key = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
                if key != now:
                    if now is not None:
                        yield row()
                    now, sides = key, (_Side(False), _Side(True))
                lines = _Lines(part.column(2))
                for side in sides:
                    side.go(lines)
        if now is not None:
            yield row()

    return lines.select("file", "block", "value").mapInArrow(run, "file bigint, block bigint, end0 boolean, end1 boolean, starts0 bigint, starts1 bigint, head string, tail0 string, tail1 string, top string")


def block_states(maps: DataFrame) -> DataFrame:
    """file, block, inside (a field is open at its start), owner (the last block
    before it in which a record begins)."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    fixed, swaps = F.col("end0") == F.col("end1"), (F.col("end0") & ~F.col("end1")).cast("int")
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = maps.withColumn("_swaps", F.sum(swaps).over(upto))
    known = F.last(F.when(fixed, F.struct(F.col("end0").cast("int").alias("s"), F.col("_swaps").alias("n"))), ignorenulls=True).over(before)
    counted = counted.withColumn("_known", known).withColumn("_turned", F.coalesce(F.last("_swaps").over(before), F.lit(0)))
    # The state that the last fixed map left (none: outside), turned by each swap since.
    state = (F.coalesce(F.col("_known.s"), F.lit(0)) + F.col("_turned") - F.coalesce(F.col("_known.n"), F.lit(0))) % 2 == 1
    counted = counted.withColumn("inside", state)
    begins = F.when(F.when(F.col("inside"), F.col("starts1")).otherwise(F.col("starts0")) > 0, F.col("block"))
    return counted.withColumn("owner", F.last(begins, ignorenulls=True).over(before)).select("file", "block", "inside", "owner")


def _torn(maps: DataFrame, states: DataFrame) -> DataFrame:
    """file, header, record: the records that reach over the end of a block."""
    known = maps.join(states, ["file", "block"])
    head = F.when(F.col("inside"), F.struct(F.col("owner"), F.col("block"), F.lit(False).alias("header"), F.col("head").alias("record")))
    tail = F.when(F.col("inside"), F.col("tail1")).otherwise(F.col("tail0"))
    tail = F.when(tail.isNotNull(), F.struct(F.col("block").alias("owner"), F.col("block"), ((F.col("block") == 0) & (F.col("starts0") == 1)).alias("header"), tail.alias("record")))
    cut = known.select("file", F.explode(F.array_compact(F.array(head, tail))).alias("_f")).select("file", "_f.*")
    pieces = F.array_sort(F.collect_list(F.struct("block", "record")))
    joined = F.array_join(F.transform(pieces, lambda x: x["record"]), "\n")
    return cut.groupBy("file", "owner").agg(F.max("header").alias("header"), joined.alias("record")).select("file", "header", "record")


def records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file, record) twice: the first record of each file, and all others; the text of
    each record, without blank ones and without the line end."""
    ship_code(spark)
    lines = physical_lines(spark, path)
    maps = stored(block_maps(lines), "csv-blocks")
    states = stored(block_states(maps), "csv-states")
    # One small row a block: broadcast, lines keep their order.
    told = lines.join(F.broadcast(states.select("file", "block", "inside")), ["file", "block"]).select("file", "block", "value", "inside")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``held``: lines of the record that is open, None where it began in another block.
        now, inside, held, top = None, False, None, False

        def out(found: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), now[0], np.int64)), found], ["file", "record"])

        def rest() -> pa.Array:
            # The last record of a block, unless it goes on in the next or is the header.
            return pa.array([] if inside or held is None or top else ["\n".join(held)], pa.string())

        for batch in batches:
            for part in _runs(batch):
                key = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
                if key != now:
                    if now is not None:
                        yield out(rest())
                    now, inside, held, top = key, part.column(3)[0].as_py(), None, False
                lines = _Lines(part.column(2))
                begins, after = lines.walk(inside)
                if held is not None:
                    held += lines.texts(0, int(begins[0]) if len(begins) else None)
                if len(begins):
                    if held is not None:
                        inside = False  # it ends where the next begins
                        yield out(rest())
                        top = False
                    elif key[1] == 0:
                        top = True
                    made = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), lines.value)
                    made = pc.binary_join(made, "\n")
                    yield out(made.slice(1) if top and len(made) else made)
                    top = top and not len(made)
                    held = lines.texts(int(begins[-1]))
                inside = after
        if now is not None:
            yield out(rest())

    whole = told.mapInArrow(run, "file bigint, record string")
    torn = stored(_torn(maps, states), "csv-torn")
    tops = maps.where("top IS NOT NULL AND (tail0 IS NULL OR starts0 > 1)").select("file", F.col("top").alias("record"))
    parts = (tops.union(torn.where("header").select("file", "record")), whole.union(torn.where("NOT header").select("file", "record")))
    heads, rows = (p.withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.trim("record") != "") for p in parts)
    return heads, rows


def parsed(names: list[str], corrupt: str, options: dict[str, str]) -> Column:
    """Column ``record`` as a struct of text columns and the corrupt-record text."""
    schema = ", ".join(f"`{c}` string" for c in [*names, corrupt])
    return F.from_csv("record", F.lit(schema), {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
