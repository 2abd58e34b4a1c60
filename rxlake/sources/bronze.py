"""Raw (Bronze) readers: header CSV bound by column name, landed JSON pages,
source statistics."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rxlake.schemas import CORRUPT_COLUMN, RAW_COLUMNS, RAW_SCHEMA
from rxlake.session import stored
from rxlake.sources.csv_scan import parsed, records
from rxlake.sources.files import CSV_TEXT

# --- fixed values: keys under which a source reports its total row count ------
TOTAL_ROW_KEYS = ("total_rows", "totalRows", "row_count", "rowCount", "count")


#: Layouts (different headers) that one read may have.
MAX_LAYOUTS = 1000


def _names(header: str) -> list[str]:
    """Column names of a header record; a blank one gets a name by its place."""
    cells = next(csv.reader([header.lstrip("\ufeff")], strict=False), [])
    return [c.strip() or f"_c{i}" for i, c in enumerate(cells)]


def read_bronze_csv(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Read raw CSV, a file or a folder, as RFC 4180 has it, over as many tasks as
    its bytes make (``sources.csv_scan``), quoted line breaks or not.

    Columns are bound by **header name** in every file, whatever the order of
    each; raw columns missing from a header are NULL, unknown extra columns are
    ignored. Malformed records (wrong token count) keep their text in
    ``_corrupt_record`` so they can be sent to the reject table instead of being
    silently padded. Headers come from the scan; what reaches the driver is each
    different one once."""
    heads, found = records(spark, path)
    headers = stored(heads.select("file", F.col("record").alias("_header")), "csv-headers")
    layouts = [r[0] for r in headers.select("_header").distinct().orderBy("_header").limit(MAX_LAYOUTS + 1).collect()]
    if len(layouts) > MAX_LAYOUTS:
        raise ValueError(f"{path} holds files of more than {MAX_LAYOUTS} layouts")
    names = [_names(h) for h in layouts]
    # Each record is parsed once, by the layout of its file.
    mine = [F.when(F.col("_header") == h, parsed(n, CORRUPT_COLUMN, CSV_TEXT)).alias(f"_r{i}") for i, (h, n) in enumerate(zip(layouts, names, strict=True))]
    rows = found.join(headers, "file").select(*mine)

    def bound(column: str) -> Column:
        held = [F.col(f"_r{i}.`{column}`") for i, n in enumerate(names) if column in [*n, CORRUPT_COLUMN]]
        return (F.coalesce(*held) if held else F.lit(None).cast("string")).alias(column)

    df = rows.select(*[bound(c) for c in [*RAW_COLUMNS, CORRUPT_COLUMN]])
    return df if year is None else df.withColumn("year", F.lit(year).cast("int"))


def read_bronze_years(spark: SparkSession, paths_by_year: dict[int, str]) -> DataFrame:
    """Read several yearly raw files (each with its own header order) into one
    DataFrame with a ``year`` column."""
    frames = [read_bronze_csv(spark, path, year) for year, path in sorted(paths_by_year.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_landed_pages(spark: SparkSession, pages_path: str, max_pages: int | None = None) -> DataFrame:
    """Landed API pages (one JSON array of records per file, named
    ``..._<n>.json``, n from 0) as one raw table with ``page_no``.

    Keys outside the raw schema are ignored, missing keys are NULL. The source
    ends at its first empty page, so pages beyond a missing number are left out.
    A page that cannot be parsed keeps its text in ``_corrupt_record``.
    ``max_pages`` keeps the first n pages (a partial load)."""
    schema = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT_COLUMN, StringType(), True)])
    reader = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1)
    df = reader.json(pages_path).withColumn("page_no", number.try_cast("int"))
    if max_pages is not None:
        df = df.where(F.col("page_no") < F.lit(max_pages))
    # One row a page: the n-th page in order must bear the number n.
    pages = df.select("page_no").distinct()
    nth = F.row_number().over(Window.orderBy("page_no")) - 1
    return df.join(pages.withColumn("_nth", nth).where("_nth = page_no").select("page_no"), "page_no", "left_semi").select(*df.columns)


def total_rows_expr(columns: list[str]) -> Column:
    """First of the known count keys holding an integer or a digit string."""
    present = [c for c in TOTAL_ROW_KEYS if c in columns]
    candidates = [
        F.when(F.col(c).cast("string").rlike(r"^[0-9]+$"), F.col(c).cast("string").try_cast("long")) for c in present
    ]
    if not candidates:
        return F.lit(None).cast("long")
    return F.coalesce(*candidates) if len(candidates) > 1 else candidates[0]


def read_source_stats(spark: SparkSession, stats_path: str) -> DataFrame:
    """Source statistics documents (JSON) with the expected row count resolved."""
    schema = StructType([StructField(k, StringType(), True) for k in TOTAL_ROW_KEYS])
    df = spark.read.schema(schema).option("multiLine", True).json(stats_path)
    return df.withColumn("expected_row_count", total_rows_expr(df.columns))
