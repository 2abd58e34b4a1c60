"""Parquet and CSV sources and sinks for the Silver and Gold layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned Parquet dataset; partition columns are discovered from folder
    names and filters on them prune whole folders."""
    return spark.read.parquet(path)


def write_partitioned_parquet(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Write ``df`` partitioned by folder (default ``year``, ``state``).

    Dynamic partition overwrite replaces only the partitions present in ``df``, so
    loading a second year keeps the first. A ``rebalance`` on the partition
    columns gives each folder few files, and AQE splits an oversized (skewed)
    partition across several writers instead of one."""
    partition_cols = partition_cols or ["year", "state"]
    (
        df.hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def replace_years(
    df: DataFrame, path: str, years: list[int], year_col: str = "year", inner: tuple[str, ...] = (), fmt: str = "parquet"
) -> None:
    """Replace whole years: the folder of each of ``years`` then holds exactly the
    rows of ``df`` for it (none, if it has none), split by the ``inner`` columns.
    Other years stay. A reload that lost a state, a reject or an outlier leaves
    nothing of it behind. ``years`` are those of one run, a handful; ``df`` should
    be a stored table, it is read once for each."""
    for year in years:
        rows = df.where(F.col(year_col) == year).drop(year_col)
        if inner:
            rows = rows.hint("rebalance", *inner)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*inner) if inner else writer).format(fmt).save(f"{path}/{year_col}={year}")


#: Options of CSV files as RFC 4180 has them: doubled quotes.
CSV_TEXT = {"header": "true", "quote": '"', "escape": '"'}


def write_csv_tables(tables: dict[str, DataFrame], root: str, files_per_table: int | None = None) -> None:
    """Export each table as header CSV under ``root/<name>``; NULL and '' both
    written blank. ``files_per_table`` deals the rows to that many files."""
    for name, df in tables.items():
        out = df.repartition(files_per_table) if files_per_table else df
        out.write.mode("overwrite").options(**CSV_TEXT, nullValue="", emptyValue="").csv(f"{root}/{name}")


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a CSV export back with a declared schema; blank fields are NULL."""
    return spark.read.schema(schema).options(**CSV_TEXT, nullValue="", multiLine="true").csv(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Truncate-and-reload of a Parquet table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
