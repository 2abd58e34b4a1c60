"""Landed API pages as a Spark data source, ``spark.read.format("landed_pages")``.

A page is a file that holds a JSON array of records; its number (from 0) is in its
name. Planning lists the folder once, ends at the first missing or empty page or at
the page limit, and deals the rest out, a range of pages to a partition: no page
beyond the end is opened by a task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from rxlake.schemas import CORRUPT_COLUMN, RAW_SCHEMA
from rxlake.session import ship_code, stored

PAGE_COLUMN = "page_no"
PAGE_SCHEMA = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT_COLUMN, StringType(), True), StructField(PAGE_COLUMN, IntegerType(), True)])
#: The number in a page's path: its one group.
PAGE_NUMBER = r"(\d+)\.json$"
#: Planning opens only pages up to this size, to see whether they are empty.
EMPTY_BYTES = 4096
PAGES_PER_TASK = 16
PAGES_PER_WRITER = 64


@dataclass
class PageRange(InputPartition):
    pages: list[tuple[int, str]]


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _text(fs: pafs.FileSystem, path: str) -> str:
    with fs.open_input_stream(path) as f:
        return f.read().decode("utf-8", "replace")


def _empty(text: str) -> bool:
    return re.fullmatch(r"\s*(\[\s*\]\s*)?", text) is not None


def _as_text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def page_records(text: str) -> list[dict] | None:
    """The records of a page, numbers as they are written; None if it is no array
    of records (nor one record)."""
    try:
        found = json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
    except ValueError:
        return None
    found = [found] if isinstance(found, dict) else found
    return found if isinstance(found, list) and all(isinstance(r, dict) for r in found) else None


class PageReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path = options["path"]
        self.pattern = options.get("pattern", PAGE_NUMBER)
        self.most = int(options["maxPages"]) if "maxPages" in options else None
        self.per_task = max(1, int(options.get("pagesPerTask", PAGES_PER_TASK)))
        self.schema = schema

    def partitions(self) -> list[PageRange]:
        fs, root = _opened(self.path)
        pages: dict[int, pafs.FileInfo] = {}
        for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            found = f.is_file and not f.base_name.startswith((".", "_")) and re.search(self.pattern, f.path)
            if found:
                number = int(found.group(1))
                if number in pages:
                    raise ValueError(f"page {number} is in two files: {pages[number].path} and {f.path}")
                pages[number] = f
        kept: list[tuple[int, str]] = []
        while len(kept) in pages and len(kept) != self.most:
            f = pages[len(kept)]
            if f.size <= EMPTY_BYTES and _empty(_text(fs, f.path)):
                break
            kept.append((len(kept), f.path))
        # A source without pages still needs one partition to plan.
        return [PageRange(kept[i : i + self.per_task]) for i in range(0, len(kept), self.per_task)] or [PageRange([])]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        fs, _ = _opened(self.path)
        types = {f.name: pa.int32() if isinstance(f.dataType, IntegerType) else pa.string() for f in self.schema}
        for number, path in partition.pages:
            text = _text(fs, path)
            records = page_records(text)
            if records == []:
                raise ValueError(f"page {number} has no records but over {EMPTY_BYTES} bytes")
            if records is None:
                records = [{CORRUPT_COLUMN: text}]
            columns = {c: [number] * len(records) if c == PAGE_COLUMN else [_as_text(r.get(c)) for r in records] for c in types}
            yield pa.RecordBatch.from_arrays([pa.array(v, types[c]) for c, v in columns.items()], schema=pa.schema(list(types.items())))


class LandedPages(DataSource):
    """Options: ``path``; ``maxPages``, the first pages only; ``pagesPerTask``;
    ``pattern``, a regular expression over a file's path whose group is the number."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> StructType:
        return PAGE_SCHEMA

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(self.options, schema)


def read_pages(spark: SparkSession, path: str, max_pages: int | None = None, **options: str) -> DataFrame:
    """Landed pages up to the first missing or empty one. Keys outside the raw
    schema are ignored, missing keys are NULL, values are text (nested ones as JSON);
    a page that cannot be parsed is one row with its text in ``_corrupt_record``."""
    ship_code(spark)
    spark.dataSource.register(LandedPages)
    reader = spark.read.format(LandedPages.name()).options(**options)
    return (reader if max_pages is None else reader.option("maxPages", max_pages)).load(path)


def write_pages(rows: DataFrame, path: str, file: str, place: str, most: int) -> None:
    """Land ``rows`` under ``path``/page=<n> as pages of at most ``most`` records, and the
    first page once more beyond a gap, where a reader must not come. ``place`` numbers
    the rows of each ``file`` from 0; a page is of one file, and its records are lines
    of one sorted task, so that none is held whole."""
    columns = [c for c in rows.columns if c not in (file, place)]
    # One row a file; nothing else passes through this window.
    held = rows.groupBy(file).agg((F.max(place) + 1).alias("_rows"))
    pages = F.ceil(F.col("_rows") / most)
    before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    held = stored(held.withColumn("_first", F.coalesce(F.sum(pages).over(before), F.lit(0))), "held")
    beyond = (held.agg(F.max(F.col("_first") + pages)).first()[0] or 0) + 1
    nth = F.col(place) % most
    opened, closed = F.when(nth == 0, "[").otherwise(","), F.when((nth == most - 1) | (F.col(place) == F.col("_rows") - 1), "]").otherwise("")
    page = F.col("_first") + F.floor(F.col(place) / most)
    numbered = rows.join(F.broadcast(held), file).withColumn("page", F.explode(F.when(page == 0, F.array(page, F.lit(beyond).cast("long"))).otherwise(F.array(page))))
    numbered = numbered.select("page", nth.alias("_nth"), opened.alias("_open"), closed.alias("_close"), *columns)
    dealt = numbered.repartitionById(beyond // PAGES_PER_WRITER + 1, F.floor(F.col("page") / PAGES_PER_WRITER).cast("int")).sortWithinPartitions("page", "_nth")
    lines = dealt.select("page", F.concat("_open", F.to_json(F.struct(*columns)), "_close").alias("value"))
    lines.write.partitionBy("page").option("compression", "gzip").text(path)
