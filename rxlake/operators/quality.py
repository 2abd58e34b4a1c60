"""Data-quality checks. Every check returns rows of the ``data_quality_result``
contract: (run_id, dataset_name, layer, check_name, status, observed_value,
expected_value, details), status in PASS / FAIL / WARN.

Checks over one table are computed in a single aggregation pass and turned into
rows with ``stack``; nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.functions.money import money_sum
from rxlake.operators.repeats import key_hash, repeated_hashes
from rxlake.schemas import CONSTRAINTS, DQ_RESULT_SCHEMA
from rxlake.session import stored

DQ_COLUMNS = DQ_RESULT_SCHEMA.fieldNames()


def _rows(one_row: DataFrame, run_id: str, dataset: str, layer: str, checks: list[tuple[str, str, str, str]]) -> DataFrame:
    """``checks``: (check_name, observed column, expected value text, failing status)."""
    stacked = one_row.select(
        F.stack(
            F.lit(len(checks)),
            *[x for name, obs, _, _ in checks for x in (F.lit(name), F.col(obs).cast("long"))],
        ).alias("check_name", "observed")
    )
    expected = {name: exp for name, _, exp, _ in checks}
    severity = {name: sev for name, _, _, sev in checks}
    exp_col = F.element_at(F.create_map(*[x for n, e in expected.items() for x in (F.lit(n), F.lit(e))]), F.col("check_name"))
    sev_col = F.element_at(F.create_map(*[x for n, s in severity.items() for x in (F.lit(n), F.lit(s))]), F.col("check_name"))
    return stacked.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset_name"),
        F.lit(layer).alias("layer"),
        "check_name",
        F.when(F.col("observed").cast("string") == exp_col, F.lit("PASS")).otherwise(sev_col).alias("status"),
        F.col("observed").cast("string").alias("observed_value"),
        exp_col.alias("expected_value"),
        F.lit(None).cast("string").alias("details"),
    )


def count_checks(
    df: DataFrame, run_id: str, dataset: str, layer: str, predicates: dict[str, tuple[Column, str]]
) -> DataFrame:
    """Rows matching each predicate must be 0 (one pass for all predicates)."""
    one = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"_c{i}") for i, (p, _) in enumerate(predicates.values())])
    checks = [(name, f"_c{i}", "0", sev) for i, (name, (_, sev)) in enumerate(predicates.items())]
    return _rows(one, run_id, dataset, layer, checks)


def silver_predicates() -> dict[str, tuple[Column, str]]:
    """NPI present (K2), no negative cost (K3), key columns not NULL (K5) and states
    defaulted to UNKNOWN (WARN): what a bad row looks like, and the failing status."""
    return {
        "npi_present": (F.col("npi").isNull() | (F.col("npi") == ""), "FAIL"),
        "no_negative_cost": ((F.col("tot_drug_cost") < 0) | (F.col("ge65_drug_cost") < 0), "FAIL"),
        "year_not_null": (F.col("year").isNull(), "FAIL"),
        "state_not_null": (F.col("state").isNull(), "FAIL"),
        "state_defaulted": (F.col("state") == "UNKNOWN", "WARN"),
    }


def silver_checks(silver: DataFrame, run_id: str, dataset: str = "prescriptions", valid_states: list[str] | None = None) -> DataFrame:
    """The ``silver_predicates`` over a stored table, in one pass, and state codes
    outside a short list (K8; for a table of codes see ``reference_check``)."""
    preds = silver_predicates()
    if valid_states is not None:
        preds["valid_state_code"] = (F.col("state").isNull() | ~F.col("state").isin(*valid_states), "FAIL")
    return count_checks(silver, run_id, dataset, "silver", preds)


def silver_metrics() -> list[Column]:
    """The same as metrics of the job that writes Silver, with its ``rows``."""
    bad = [F.count_if(F.coalesce(p, F.lit(False))).alias(name) for name, (p, _) in silver_predicates().items()]
    return [F.count(F.lit(1)).alias("rows"), *bad]


def number_checks(spark: SparkSession, run_id: str, dataset: str, layer: str, numbers: dict[str, tuple[int, int, str]]) -> DataFrame:
    """Rows from numbers that a job has counted: check -> observed, expected, failing
    status."""
    rows = [(run_id, dataset, layer, name, "PASS" if seen == wanted else bad, str(seen), str(wanted), None) for name, (seen, wanted, bad) in numbers.items()]
    return spark.createDataFrame(rows, DQ_RESULT_SCHEMA)


def written_silver_checks(spark: SparkSession, metrics: dict[str, int], run_id: str, dataset: str) -> DataFrame:
    """K2, K3 and K5 from the metrics of the write itself: Silver is not read again."""
    return number_checks(spark, run_id, dataset, "silver", {name: (metrics[name], 0, bad) for name, (_, bad) in silver_predicates().items()})


@dataclass(frozen=True)
class RowFlow:
    """Rows of one load: staged, sent to deduplication, left by it, and what the
    reject and Silver tables hold afterwards."""

    staged: int
    accepted: int
    unique: int
    rejected_stored: int
    silver_stored: int


def row_flow_check(spark: SparkSession, flow: RowFlow, run_id: str, dataset: str) -> DataFrame:
    """K10: staged rows that are neither accepted nor in the stored reject table, and
    unique rows that the stored Silver table lacks; both must be 0."""
    lost = flow.staged - flow.rejected_stored - flow.accepted
    numbers = {"bronze_minus_rejected_equals_accepted": (lost, 0, "FAIL"), "silver_written_equals_unique": (flow.silver_stored, flow.unique, "FAIL")}
    return number_checks(spark, run_id, dataset, "silver", numbers)


def reference_check(df: DataFrame, column: str, reference: DataFrame, run_id: str, dataset: str, layer: str, check_name: str) -> DataFrame:
    """Rows whose ``column`` is not in the one-column table ``reference`` (K8); a
    NULL is not. Values are counted before they meet the reference."""
    values = df.groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    known = reference.select(F.col(reference.columns[0]).alias("_r")).distinct()
    bad = values.join(known, F.col("_v") == F.col("_r"), "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_bad"))
    return _rows(bad, run_id, dataset, layer, [(check_name, "_bad", "0", "FAIL")])


def duplicate_key_check(df: DataFrame, keys: list[str], run_id: str, dataset: str, layer: str, check_name: str) -> DataFrame:
    """Number of key values held by more than one row (K4); must be 0.

    Keys are compared only where their hash occurs twice; a sound table moves hashes
    alone. ``df`` is read twice and should be stored, or follow from a stored table
    without a shuffle."""
    again = repeated_hashes(df, keys)
    suspect = df.select(*keys, key_hash(keys).alias("_hash")).join(again, "_hash", "left_semi")
    dups = suspect.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("_dups"))
    return _rows(dups, run_id, dataset, layer, [(check_name, "_dups", "0", "FAIL")])


def not_null_check(df: DataFrame, columns: list[str], run_id: str, dataset: str, layer: str, check_name: str) -> DataFrame:
    """Rows with a NULL in any declared NOT NULL column (K5)."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return count_checks(df, run_id, dataset, layer, {check_name: (any_null, "FAIL")})


def orphan_check(orphans: DataFrame, run_id: str, dataset: str) -> DataFrame:
    """Fact rows without a dimension row, per foreign key (K9, from ``star.orphans``)."""
    return orphans.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset_name"),
        F.lit("gold").alias("layer"),
        F.concat(F.lit("orphans_"), F.col("foreign_key")).alias("check_name"),
        F.when(F.col("orphan_rows") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.col("orphan_rows").cast("string").alias("observed_value"),
        F.lit("0").alias("expected_value"),
        F.lit(None).cast("string").alias("details"),
    )


def year_completeness(df: DataFrame, expected_years: list[int], run_id: str, dataset: str, layer: str = "silver") -> DataFrame:
    """Expected years absent from ``df`` (K7); details list them."""
    spark = df.sparkSession
    expected = spark.createDataFrame([(int(y),) for y in expected_years], "year int")
    missing = expected.join(df.select("year").distinct(), "year", "left_anti")
    agg = missing.agg(
        F.count(F.lit(1)).alias("_missing"),
        F.array_join(F.sort_array(F.collect_list(F.col("year").cast("string"))), ",").alias("_list"),
    )
    return agg.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset_name"),
        F.lit(layer).alias("layer"),
        F.lit("year_completeness").alias("check_name"),
        F.when(F.col("_missing") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.col("_missing").cast("string").alias("observed_value"),
        F.lit("0").alias("expected_value"),
        F.when(F.col("_missing") > 0, F.concat(F.lit("missing years: "), F.col("_list"))).alias("details"),
    )


def status_domain_check(log: DataFrame, domain: tuple[str, ...], run_id: str, dataset: str, layer: str, check_name: str) -> DataFrame:
    """Status values outside the allowed domain (K11)."""
    return count_checks(log, run_id, dataset, layer, {check_name: (~F.col("status").isin(*domain) | F.col("status").isNull(), "FAIL")})


def reconcile(silver: DataFrame, mart: DataFrame, grain: list[str], tolerance: float = 0.005) -> DataFrame:
    """Gold vs Silver on a grain (C5): totals of claims and cost recomputed from
    Silver, full outer joined to the mart, compared NULL-safely (cost within
    ``tolerance``). One row per grain value with match flags."""
    s = silver.groupBy(*grain).agg(
        F.sum("tot_claims").alias("silver_claims"), money_sum("tot_drug_cost").alias("silver_cost")
    )
    g = mart.select(*grain, F.col("total_claims").alias("gold_claims"), F.col("total_drug_cost").alias("gold_cost"))
    j = s.join(g, grain, "full_outer")
    return j.withColumn("claims_match", F.col("silver_claims").eqNullSafe(F.col("gold_claims"))).withColumn(
        "cost_match",
        F.coalesce(F.abs(F.col("silver_cost") - F.col("gold_cost")) <= F.lit(tolerance), F.lit(False))
        | (F.col("silver_cost").isNull() & F.col("gold_cost").isNull()),
    )


def unmatched_check(df: DataFrame, parent: DataFrame, keys: list[str], run_id: str, dataset: str, check_name: str) -> DataFrame:
    """Rows without a row in ``parent`` that is equal on ``keys`` (NULLs too); must be 0."""
    other = parent.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    lost = df.join(other, same, "left_anti").agg(F.count(F.lit(1)).alias("_lost"))
    return _rows(lost, run_id, dataset, "gold", [(check_name, "_lost", "0", "FAIL")])


def reconcile_check(recon: DataFrame, run_id: str, dataset: str, check_name: str) -> DataFrame:
    return count_checks(recon, run_id, dataset, "gold", {check_name: (~(F.col("claims_match") & F.col("cost_match")), "FAIL")})


def row_count_check(counted: DataFrame, run_id: str) -> DataFrame:
    """K1: loaded rows against the source's count, by year (``counted``: a
    manifest with ``count_status``)."""
    return counted.select(
        F.lit(run_id).alias("run_id"),
        "dataset_name",
        F.lit("bronze").alias("layer"),
        F.concat(F.lit("row_count_"), F.col("year").cast("string")).alias("check_name"),
        F.col("count_status").alias("status"),
        F.col("row_count").cast("string").alias("observed_value"),
        F.col("expected_row_count").cast("string").alias("expected_value"),
        F.lit(None).cast("string").alias("details"),
    )


def constraint_checks(tables: dict[str, DataFrame], run_id: str, dataset: str) -> DataFrame:
    """K4 and K5 for every gold table given: declared keys are unique (a key with
    a NULL part is not compared, as in SQL), declared columns are not NULL."""
    frames = []
    for name, df in tables.items():
        keys, filled = CONSTRAINTS[name]
        for key in keys:
            whole = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]))
            frames.append(duplicate_key_check(whole, key, run_id, dataset, "gold", f"{name}_{'_'.join(key)}_unique"))
        if filled:
            frames.append(count_checks(df, run_id, dataset, "gold", {f"{name}_{c}_not_null": (F.col(c).isNull(), "FAIL") for c in filled}))
    return union_all(frames)


def reconcile_tables(expected: DataFrame, stored: DataFrame, keys: list[str], measures: list[str], tolerance: float = 0.005) -> DataFrame:
    """One row a key on which the stored table differs from the expected one:
    keys and ``difference`` (missing, unexpected or the differing measures)."""
    one = expected.select(*keys, F.struct(*measures).alias("_e"))
    two = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*measures).alias("_s"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    j = one.join(two, same, "full_outer")

    def differs(m: str) -> Column:
        e, s = F.col(f"_e.{m}"), F.col(f"_s.{m}")
        return ~(e.eqNullSafe(s) | F.coalesce(F.abs(e - s) <= tolerance, F.lit(False)))

    changed = F.concat_ws(",", *[F.when(differs(m), F.lit(m)) for m in measures])
    what = F.when(F.col("_s").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").otherwise(changed)
    return j.select(*[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys], what.alias("difference")).where("difference <> ''")


def differing_rows(expected: DataFrame, stored_table: DataFrame, keys: list[str], measures: list[str], fanout: int = 256, levels: int = 3, tolerance: float = 0.005) -> DataFrame:
    """``reconcile_tables`` of two large tables that differ in little, by a tree of
    fingerprints: rows fall into ``fanout`` ** level ranges by hash of their key, a
    range's fingerprint is the exact sum of its rows' hashes (a partial aggregate),
    and only ranges that differ are read at the next level. What is left is joined.
    ``expected`` and ``stored_table`` are read once a level and should be stored."""
    key_hash, row_hash = F.xxhash64(*keys), F.xxhash64(*keys, *measures).cast("decimal(20,0)")

    def prints(df: DataFrame, ranges: int, name: str) -> DataFrame:
        return df.groupBy(F.pmod(key_hash, F.lit(ranges)).alias("_range")).agg(F.count(F.lit(1)).alias(f"_n{name}"), F.sum(row_hash).alias(f"_s{name}"))

    def inside(df: DataFrame, ranges: int, some: DataFrame) -> DataFrame:
        return df.withColumn("_range", F.pmod(key_hash, F.lit(ranges))).join(some, "_range", "left_semi").drop("_range")

    left, right = expected, stored_table
    for level in range(1, levels + 1):
        ranges = fanout**level
        met = prints(left, ranges, "a").join(prints(right, ranges, "b"), "_range", "full_outer")
        # Ranges of a level lie within those of the one before: pmod by a multiple.
        differ = stored(met.where(~(F.col("_na").eqNullSafe(F.col("_nb")) & F.col("_sa").eqNullSafe(F.col("_sb")))).select("_range"), "ranges")
        left, right = inside(expected, ranges, differ), inside(stored_table, ranges, differ)
    return reconcile_tables(left, right, keys, measures, tolerance)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).select(*DQ_COLUMNS)
