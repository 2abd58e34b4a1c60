"""Run a registered Spark query and its DuckDB statement and compare results
(row count, column names, values; order-insensitive)."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)) else v)
        df[c] = df[c].map(lambda v: repr(v) if isinstance(v, float) else v)
        df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for name, dtype in spark_df.dtypes:
        if SPARK_TO_DUCK.get(dtype, dtype) != duck_types.get(name):
            return False, f"type of {name}: spark {dtype} vs sql {duck_types.get(name)}"
    left = spark_df.toPandas()
    right = con.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"row counts differ: spark {len(left)} vs sql {len(right)}"
    a, b = _canon(left), _canon(right)
    diff = (a != b).any(axis=1)
    if diff.any():
        i = int(diff.idxmax())
        cols = [c for c in a.columns if a.loc[i, c] != b.loc[i, c]]
        return False, f"{int(diff.sum())} rows differ; first at {i}: " + "; ".join(
            f"{c}: {a.loc[i, c]} vs {b.loc[i, c]}" for c in cols[:4]
        )
    return True, f"{len(left)} rows equal"
