"""Lineage records: table fingerprint, load manifest, run log, skip rule and the
row-count check against the source's expected count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StructField, StructType

from rxlake.operators.upsert import upsert_by_key
from rxlake.schemas import INGESTION_LOG_KEY, INGESTION_LOG_SCHEMA, INGESTION_STATUSES, MANIFEST_SCHEMA


def row_hashes(columns: list[str]) -> list[Column]:
    """Two whole numbers from the SHA-256 of a row's text (NULL marked), which
    any engine can compute."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("__NULL__")) for c in columns])
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]


def fingerprint_aggs(columns: list[str], hashes: tuple[str, str] | None = None) -> list[Column]:
    """Row count and an order-insensitive content fingerprint.

    Each row has two hashes over all ``columns`` (or ``hashes`` names columns that
    hold them); they are summed exactly, so the result does not depend on row
    order or partitioning but changes with any edit, insert or delete. The hex
    SHA-256 of (count, both sums) is the checksum."""
    pair = [F.col(c) for c in hashes] if hashes else row_hashes(columns)
    n = F.count(F.lit(1))
    sums = [F.coalesce(F.sum(c.cast(DecimalType(38, 0))).cast("string"), F.lit("0")) for c in pair]
    checksum = F.sha2(F.concat_ws(":", n.cast("string"), *sums), 256)
    return [n.alias("row_count"), checksum.alias("checksum_sha256")]


def table_fingerprint(
    df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None, hashes: tuple[str, str] | None = None
) -> DataFrame:
    columns = columns or [c for c in df.columns if c not in (by or [])]
    aggs = fingerprint_aggs(columns, hashes)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def build_manifest(
    raw: DataFrame,
    dataset_name: str,
    dataset_id: str,
    source_url: str,
    page_size: int,
    ingested_at: str,
    year_col: str = "year",
    expected: DataFrame | None = None,
    columns: list[str] | None = None,
    hashes: tuple[str, str] | None = None,
) -> DataFrame:
    """One manifest row per year of a raw table (``MANIFEST_SCHEMA``).

    ``expected`` (year, expected_row_count) comes from the source statistics;
    ``ingested_at`` is passed in (ISO UTC text) so reruns are reproducible."""
    cols = columns or [c for c in raw.columns if c != year_col]
    per_year = table_fingerprint(raw.withColumnRenamed(year_col, "year"), cols, by=["year"], hashes=hashes)
    if expected is not None:
        per_year = per_year.join(expected.select("year", "expected_row_count"), "year", "left")
    else:
        per_year = per_year.withColumn("expected_row_count", F.lit(None).cast("long"))
    lit = {
        "dataset_name": F.lit(dataset_name),
        "dataset_id": F.lit(dataset_id),
        "source_url": F.lit(source_url),
        "page_size": F.lit(page_size).cast("int"),
        "ingested_at": F.lit(ingested_at),
    }
    return per_year.select(
        *[
            (lit[f.name] if f.name in lit else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in MANIFEST_SCHEMA.fields
        ]
    )


def write_manifest(manifest: DataFrame, path: str, years: list[int]) -> None:
    """Manifest rows as JSON, one file a year; other years keep theirs."""
    from rxlake.sources.files import replace_years

    replace_years(manifest.repartition(1), path, years, fmt="json")


def row_count_status(manifest: DataFrame, partial: bool = False) -> DataFrame:
    """K1: PASS when the loaded count equals the expected one (or none is
    known); FAIL on a mismatch, WARN instead when the load was partial."""
    mismatch = F.col("expected_row_count").isNotNull() & (F.col("row_count") != F.col("expected_row_count"))
    status = F.when(~mismatch, F.lit("PASS")).otherwise(F.lit("WARN" if partial else "FAIL"))
    return manifest.withColumn("count_status", status)


def log_records(
    manifest: DataFrame,
    run_id: str,
    status: str,
    started_at: str,
    completed_at: str | None,
    file_path: str,
    manifest_path: str,
    error_message: str | None = None,
) -> DataFrame:
    """Run-log rows (``INGESTION_LOG_SCHEMA``) for each manifest row.

    ``file_path`` / ``manifest_path`` may contain ``{year}``."""
    if status not in INGESTION_STATUSES:
        raise ValueError(f"status must be one of {INGESTION_STATUSES}")

    def templ(t: str) -> Column:
        head, _, tail = t.partition("{year}")
        return F.concat(F.lit(head), F.col("year").cast("string"), F.lit(tail)) if "{year}" in t else F.lit(t)

    values = {
        "run_id": F.lit(run_id),
        "file_path": templ(file_path),
        "manifest_path": templ(manifest_path),
        "object_etag": F.lit(None),
        "status": F.lit(status),
        "started_at": F.to_timestamp(F.lit(started_at)),
        "completed_at": F.to_timestamp(F.lit(completed_at)) if completed_at else F.lit(None),
        "error_message": F.lit(error_message),
    }
    return manifest.select(
        *[
            (values[f.name] if f.name in values else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in INGESTION_LOG_SCHEMA.fields
        ]
    )


def upsert_run_log(log: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert or replace run-log rows by (run_id, dataset_name, year)."""
    return upsert_by_key(log, incoming, INGESTION_LOG_KEY)


def append_log(rows: DataFrame, path: str) -> None:
    """Add run-log rows as one more event: nothing stored is rewritten."""
    found = read_log(rows.sparkSession, path)
    last = found.agg(F.max("seq")).first()[0]
    rows.withColumn("seq", F.lit((last or 0) + 1)).write.mode("append").partitionBy("seq").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The run log: of each (run, dataset, year) its latest event, and ``seq``, the
    order of events."""
    schema = StructType([*INGESTION_LOG_SCHEMA.fields, StructField("seq", IntegerType())])
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    events = spark.read.schema(schema).parquet(path)
    latest = events.groupBy(*INGESTION_LOG_KEY).agg(F.max_by(F.struct(*[c for c in events.columns if c not in INGESTION_LOG_KEY]), "seq").alias("e"))
    return latest.select(*[c if c in INGESTION_LOG_KEY else F.col(f"e.{c}").alias(c) for c in events.columns])


def skip_ingested(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """Manifest rows still to load: without those whose content is what the latest
    successful load of their dataset and year had. Content that an earlier load had
    and a later one replaced is loaded again."""
    order = F.struct(*[c for c in ("seq", "completed_at", "run_id") if c in log.columns])
    done = log.where(F.col("status") == "SUCCESS").groupBy("dataset_id", "year").agg(F.max_by("checksum_sha256", order).alias("checksum_sha256"))
    return manifest.join(done, ["dataset_id", "year", "checksum_sha256"], "left_anti")


def checksum_check(current: DataFrame, recorded: DataFrame, run_id: str) -> DataFrame:
    """K12: per (dataset, year), PASS when the content fingerprint equals the one
    recorded earlier, FAIL when it changed, WARN when nothing was recorded."""
    rec = recorded.select("dataset_name", "year", F.col("checksum_sha256").alias("_recorded"))
    j = current.join(rec, ["dataset_name", "year"], "left")
    status = (
        F.when(F.col("_recorded").isNull(), F.lit("WARN"))
        .when(F.col("_recorded") == F.col("checksum_sha256"), F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
    )
    return j.select(
        F.lit(run_id).alias("run_id"),
        "dataset_name",
        F.lit("bronze").alias("layer"),
        F.concat(F.lit("checksum_unchanged_"), F.col("year").cast("string")).alias("check_name"),
        status.alias("status"),
        F.col("checksum_sha256").alias("observed_value"),
        F.col("_recorded").alias("expected_value"),
        F.lit(None).cast("string").alias("details"),
    )
