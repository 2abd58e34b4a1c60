"""Layer assemblies: Bronze -> Silver -> Gold (star + marts) and the full run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from rxlake.functions.keys import full_name
from rxlake.operators import clean, lineage, marts, outliers, quality, star
from rxlake.operators.lineage import row_hashes
from rxlake.operators.upsert import read_if_exists
from rxlake.schemas import CORRUPT_COLUMN, DQ_RESULT_SCHEMA, MART_COLUMNS, RAW_COLUMNS, SILVER_KEY, SILVER_SCHEMA, STAR_COLUMNS, conform
from rxlake.session import PARQUET, cut_lineage
from rxlake.sources.files import write_csv_tables
from rxlake.sources.standin import standin_raw
from rxlake.sources.versions import Lake


def silver_from_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows derived from the test tables (year from the order date)."""
    return clean.to_silver(standin_raw(spark, sf_dir), year_col="yr")


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return star.star_schema(silver)


def gold_marts(silver: DataFrame, materialize_summary: bool = False, anomalies: bool = True, **outlier_args) -> dict[str, DataFrame]:
    """The five marts. The prescriber summary feeds two of them; with
    ``materialize_summary`` it is computed once and checkpointed to the shared
    checkpoint folder so the anomaly mart reads it instead of Silver."""
    summary = marts.prescriber_summary(silver)
    if materialize_summary:
        summary = cut_lineage(summary)
    tables = {
        "gold_state_year_spending": marts.mart("gold_state_year_spending")(silver),
        "gold_drug_year_spending": marts.mart("gold_drug_year_spending")(silver),
        "gold_specialty_state_spending": marts.mart("gold_specialty_state_spending")(silver),
        "gold_prescriber_summary": summary,
    }
    if anomalies:
        # A checkpointed summary is read directly; otherwise the outlier operator
        # materialises its own copy once.
        tables["gold_anomaly_prescribers"] = outliers.anomaly_prescribers(
            summary, **{"materialize": not materialize_summary, **outlier_args}
        )
    return tables


class IncompleteLoad(ValueError):
    """The rows of a full load do not match the count that the source reports."""


def stage_bronze(bronze: DataFrame, path: str) -> DataFrame:
    """Raw rows parsed once and stored: Silver columns, reject reasons, and two
    hashes of the raw text for the content fingerprint. Everything else in the
    job reads this table."""
    raw = [c for c in bronze.columns if c not in ("year", CORRUPT_COLUMN)]
    hashed = bronze.withColumns(dict(zip(("_x", "_m"), row_hashes(raw), strict=True)))
    typed = clean.flag_rejects(hashed, extra=["_x", "_m"])
    typed.write.mode("overwrite").options(**PARQUET).parquet(path)
    return bronze.sparkSession.read.schema(typed.schema).parquet(path)


def write_silver(lake: Lake, staged: DataFrame, years: list[int]) -> tuple[quality.RowFlow, dict[str, int]]:
    """Stage Silver and the rejects of ``years`` from the staged rows; the counts that
    the writes made, and Silver's metrics.

    Rows are counted where they pass: accepted ones on their way to deduplication (those
    with a key of their own and the others), unique ones in the stage that writes them. Stored rows are counted from the
    tables, by file footers. A stage that runs again after a lost executor may count
    rows on their way twice, so a difference is counted again before it stands."""
    ok = F.size("reject_reasons") == 0
    mine = staged.where(F.col("year").isin(years)).drop("_x", "_m")
    accepted = mine.where(ok).drop("reject_reasons", CORRUPT_COLUMN)
    sent, made = [], Observation()

    def counted(part: DataFrame) -> DataFrame:
        sent.append(Observation())
        return part.observe(sent[-1], F.count(F.lit(1)).alias("rows"))

    fresh = clean.dedup_typed(accepted, watch=counted)
    lake.stage("silver", fresh, years, inner=("state",), observe=(made, quality.silver_metrics()))
    rejected = mine.where(~ok)
    lake.stage("rejects", rejected, years)
    total = mine.count()
    refused = lake.read("rejects", rejected.schema, years).count()
    flow = quality.RowFlow(total, sum(part.get.get("rows", 0) for part in sent), made.get["rows"], refused, lake.read("silver", SILVER_SCHEMA, years).count())
    if flow.staged - flow.rejected_stored != flow.accepted:
        flow = replace(flow, accepted=accepted.count())
    return flow, made.get


def gold_plans(silver: DataFrame) -> dict[str, DataFrame]:
    """Fact and the four aggregate marts of Silver rows."""
    fact = conform(star.fact_prescriptions(silver), STAR_COLUMNS["fact_prescriptions"])
    return {"fact_prescriptions": fact, **gold_marts(silver, anomalies=False)}


def run_pipeline(
    spark: SparkSession,
    bronze: DataFrame,
    out_root: str,
    run_id: str,
    dataset: str = "prescriptions",
    expected_years: list[int] | None = None,
    expected_counts: DataFrame | None = None,
    partial: bool = False,
    ingested_at: str = "1970-01-01T00:00:00+00:00",
    export_csv: bool = True,
    skip_loaded: bool = True,
    valid_states: DataFrame | None = None,
    **outlier_args,
) -> dict[str, DataFrame]:
    """The whole batch job over raw rows with a ``year`` column.

    Under ``out_root``: ``bronze/<run>`` (parsed rows); versioned tables behind one
    pointer (``sources.versions``): ``silver`` by year and state, ``rejects`` by year,
    the star schema, its yearly parts of dimensions, and five marts; ``exports/<table>``
    (header CSV), ``quality`` (by run), ``manifest`` (JSON, by year), ``run_log`` (events).

    A run replaces whole years: Silver, rejects, fact, marts and manifest of its
    years afterwards hold exactly what these rows give. Dimensions are merged from the
    stored parts of all years, so only the loaded years' Silver is read, and any order
    of loads and corrections ends in the same tables as one load of everything. All
    tables switch together; a run that dies before leaves the former ones. Years whose
    latest load had the same content are skipped (``skip_loaded``). With
    ``expected_counts`` (year, expected_row_count) a full load whose count differs is
    logged as FAILED and stops before Silver; a ``partial`` one goes on with a warning.
    ``valid_states`` (one column) is the reference of state codes. Raw rows are read once."""

    def log(rows: DataFrame, status: str, message: str | None = None) -> None:
        done = None if status == "RUNNING" else ingested_at
        lineage.append_log(lineage.log_records(rows, run_id, status, ingested_at, done, f"{out_root}/bronze/{run_id}", f"{out_root}/manifest/year={{year}}", message), f"{out_root}/run_log")

    lake = Lake(spark, out_root)
    staged = stage_bronze(bronze, f"{out_root}/bronze/{run_id}")
    manifest = cut_lineage(lineage.build_manifest(staged, dataset, dataset, "bronze", 0, ingested_at, expected=expected_counts, hashes=("_x", "_m")))
    todo = lineage.skip_ingested(manifest, lineage.read_log(spark, f"{out_root}/run_log")) if skip_loaded else manifest
    counted = lineage.row_count_status(manifest, partial)
    bad = [r["year"] for r in counted.where("count_status = 'FAIL'").select("year").collect()]  # a handful of years
    if bad:
        log(manifest.where(F.col("year").isin(bad)), "FAILED", "row count differs from the source's")
        raise IncompleteLoad(f"years {sorted(bad)}: row count differs from the source's")
    years = sorted(r["year"] for r in todo.select("year").collect())  # a handful
    mine = manifest.where(F.col("year").isin(years))
    per_year = "year" in outlier_args.get("peer_keys", ("year",))
    if years:
        log(mine, "RUNNING")
        flow, metrics = write_silver(lake, staged, years)
        silver = lake.read("silver", SILVER_SCHEMA, years)
        parts = star.dim_parts(silver)
        for name, part in parts.items():
            lake.stage(f"parts_{name}", part, years)
        for name, dim in star.merge_dims({n: lake.read(f"parts_{n}", p.schema) for n, p in parts.items()}).items():
            lake.stage(name, conform(dim, STAR_COLUMNS[name]))
        made = gold_plans(silver)
        for name, df in made.items():
            lake.stage(name, df, years, "year_id" if name == "fact_prescriptions" else "year")
        # Peer groups that span years change with any of them.
        peers = None if per_year else sorted(int(y) for y in lake.parts["silver"])
        summary = lake.read("gold_prescriber_summary", made["gold_prescriber_summary"].schema, years if per_year else None)
        flagged = outliers.anomaly_prescribers(summary, **{"materialize": False, **outlier_args})
        lake.stage("gold_anomaly_prescribers", flagged, peers or years)

    tables = _tables(lake)
    if years:
        loaded = {n: df.where(F.col(c).isin(years)) if (c := "year_id" if n == "fact_prescriptions" else "year") in df.columns and n.startswith(("gold_", "fact_")) else df for n, df in tables.items()}
        checks = [
            quality.written_silver_checks(spark, metrics, run_id, dataset),
            quality.row_flow_check(spark, flow, run_id, dataset),
            quality.duplicate_key_check(silver, SILVER_KEY, run_id, dataset, "silver", "silver_grain_unique"),
            quality.duplicate_key_check(loaded["gold_prescriber_summary"], ["mart_id"], run_id, dataset, "gold", "prescriber_summary_key_unique"),
            quality.constraint_checks({n: loaded[n] for n in [*STAR_COLUMNS, *MART_COLUMNS]}, run_id, dataset),
            quality.orphan_check(star.orphans(loaded), run_id, dataset),
            *[
                quality.reconcile_check(quality.reconcile(rows, loaded[mart], list(grain)), run_id, dataset, name)
                for name, mart, grain, rows in (
                    ("reconcile_state_year", "gold_state_year_spending", ("year", "state"), silver),
                    ("reconcile_drug_year", "gold_drug_year_spending", ("year", "brand_name", "generic_name"), silver),
                    ("reconcile_specialty_state", "gold_specialty_state_spending", ("year", "state", "specialty"), silver),
                    ("reconcile_prescriber", "gold_prescriber_summary", marts.SPECS["gold_prescriber_summary"].grain, silver.withColumn("full_name", full_name())),
                )
            ],
            quality.unmatched_check(loaded["gold_anomaly_prescribers"], loaded["gold_prescriber_summary"], [c for c in MART_COLUMNS["gold_anomaly_prescribers"] if c in MART_COLUMNS["gold_prescriber_summary"]], run_id, dataset, "anomalies_in_summary"),
            quality.row_count_check(counted, run_id),
        ]
        if valid_states is not None:
            checks.append(quality.reference_check(silver, "state", valid_states, run_id, dataset, "silver", "valid_state_code"))
        if expected_years:
            checks.append(quality.year_completeness(tables["silver"], expected_years, run_id, dataset))
        found = quality.union_all(checks).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        found.partitionBy("run_id").parquet(f"{out_root}/quality")
        lake.commit()
        if export_csv:
            write_csv_tables({n: tables[n] for n in [*STAR_COLUMNS, *MART_COLUMNS]}, f"{out_root}/exports")
        lineage.write_manifest(manifest, f"{out_root}/manifest", years)
        log(mine, "SUCCESS")
    results = read_if_exists(spark, f"{out_root}/quality")
    return {
        **tables,
        "quality": spark.createDataFrame([], DQ_RESULT_SCHEMA) if results is None else results,
        "run_log": lineage.read_log(spark, f"{out_root}/run_log").drop("seq"),
    }


def _tables(lake: Lake) -> dict[str, DataFrame]:
    """Silver, rejects, star and marts of a lake, with the schemas that their plans
    declare (a year may hold no rows)."""
    empty = lake.spark.createDataFrame([], SILVER_SCHEMA)
    raw = lake.spark.createDataFrame([], ", ".join([*(f"{c} string" for c in [*RAW_COLUMNS, CORRUPT_COLUMN]), "year int"]))
    plans = {"silver": empty, "rejects": clean.flag_rejects(raw), **gold_tables(empty), **gold_plans(empty)}
    schemas = {n: (conform(df, STAR_COLUMNS[n]) if n in STAR_COLUMNS else df).schema for n, df in plans.items()}
    summary = lake.spark.createDataFrame([], schemas["gold_prescriber_summary"])
    columns = {**{f.name: f for f in summary.schema}, "peer_p95_cost_per_claim": StructField("peer_p95_cost_per_claim", DoubleType()), "anomaly_reason": StructField("anomaly_reason", StringType())}
    schemas["gold_anomaly_prescribers"] = StructType([columns[c] for c in MART_COLUMNS["gold_anomaly_prescribers"]])
    return {n: lake.read(n, s, year_col="year_id" if n == "fact_prescriptions" else "year") for n, s in schemas.items()}


def open_lake(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    """The tables that the last finished run left."""
    return _tables(Lake(spark, out_root))
