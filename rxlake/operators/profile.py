"""Dataset inspection: row count, schema and per-column statistics in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative standard error of approximate distinct counts.
RSD = 0.05


def _as_text(c: Column, kind: str) -> Column:
    """Plain text of a value; doubles with six decimals, in every engine alike."""
    return (c.cast("decimal(38,6)") if kind in ("double", "float") else c).cast("string")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULLs, distinct values (HyperLogLog, see
    ``RSD``), min and max (as text). All from a single aggregation."""
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        aggs += [
            F.count_if(col.isNull()).alias(f"_n{i}"),
            F.approx_count_distinct(col, RSD).alias(f"_d{i}"),
            _as_text(F.min(col), types[c]).alias(f"_lo{i}"),
            _as_text(F.max(col), types[c]).alias(f"_hi{i}"),
        ]
    one = df.agg(*aggs)
    values = [
        x
        for i, c in enumerate(df.columns)
        for x in (F.lit(i), F.lit(c), F.lit(types[c]), F.col(f"_n{i}"), F.col(f"_d{i}"), F.col(f"_lo{i}"), F.col(f"_hi{i}"))
    ]
    names = ("position", "column_name", "data_type", "null_count", "approx_distinct", "min_value", "max_value")
    return one.select(F.col("_rows").alias("row_count"), F.stack(F.lit(len(df.columns)), *values).alias(*names))


def exact_distinct(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, distinct_count: one two-step aggregate a column, which reads
    that column alone; rows are not expanded."""
    frames = [
        df.select(F.col(f"`{c}`").alias("_v")).distinct().agg(F.count("_v").alias("distinct_count")).select(F.lit(c).alias("column_name"), "distinct_count")
        for c in columns or df.columns
    ]
    return reduce(DataFrame.unionByName, frames)


def head(df: DataFrame, n: int = 20, order: list[str] | None = None) -> DataFrame:
    """The first n rows; with ``order`` (ascending, NULLs last) always the same."""
    return (df.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else df).limit(n)
