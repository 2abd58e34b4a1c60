from rxlake.sources.bronze import (
    read_bronze_csv,
    read_bronze_years,
    read_landed_pages,
    read_source_stats,
    total_rows_expr,
)
from rxlake.sources.files import (
    overwrite_table,
    read_csv_table,
    read_parquet_table,
    write_csv_tables,
    write_partitioned_parquet,
)
from rxlake.sources.standin import read_tables, standin_raw

__all__ = [
    "overwrite_table",
    "read_bronze_csv",
    "read_bronze_years",
    "read_csv_table",
    "read_landed_pages",
    "read_parquet_table",
    "read_source_stats",
    "read_tables",
    "standin_raw",
    "total_rows_expr",
    "write_csv_tables",
    "write_partitioned_parquet",
]
