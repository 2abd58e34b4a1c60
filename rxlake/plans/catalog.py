"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame built
from the test tables, with its DuckDB statement in ``ORACLE``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.operators import clean, lineage, marts, outliers, profile, quality, star, upsert, views
from rxlake.plans import oracle as O
from rxlake.plans.pipeline import gold_marts, gold_tables, silver_from_standin, stage_bronze, write_silver
from rxlake.schemas import CORRUPT_COLUMN, MART_LOAD_ORDER, SILVER_COLUMNS, SILVER_KEY, STAR_LOAD_ORDER
from rxlake.session import cut_lineage, ensure_checkpoint_dir, stored
from rxlake.sources.bronze import read_bronze_csv, total_rows_expr
from rxlake.sources.files import CSV_TEXT
from rxlake.sources.layout import read_top, write_banded, write_sized
from rxlake.sources.pages import read_pages, write_pages
from rxlake.sources.standin import standin_raw
from rxlake.sources.versions import Lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prescriber_summary(silver_from_standin(spark, sf_dir))


# --- Silver ---------------------------------------------------------------------


@register("silver_clean", O.with_ctes(["silver"], "SELECT * FROM silver"))
def silver_clean(spark, sf_dir):
    return silver_from_standin(spark, sf_dir)


# --- marts ------------------------------------------------------------------------


@register("mart_prescriber", O.with_ctes(["summary"], "SELECT * FROM summary"))
def mart_prescriber(spark, sf_dir):
    return _summary(spark, sf_dir)


@register(
    "mart_anomaly",
    O.with_ctes(
        ["summary", "thr"],
        O.anomaly(["year", "state", "specialty"]),
        extra={"thr": O.thresholds_disc("summary", ["year", "state", "specialty"], "avg_cost_per_claim", 0.95)},
        extra_deps={"thr": ["summary"]},
    ),
)
def mart_anomaly(spark, sf_dir):
    return outliers.anomaly_prescribers(_summary(spark, sf_dir))


@register(
    "anomaly_year_specialty",
    O.with_ctes(
        ["summary", "thr"],
        O.anomaly(["year", "specialty"]),
        extra={"thr": O.thresholds_disc("summary", ["year", "specialty"], "avg_cost_per_claim", 0.95)},
        extra_deps={"thr": ["summary"]},
    ),
)
def anomaly_year_specialty(spark, sf_dir):
    return outliers.anomaly_prescribers(_summary(spark, sf_dir), peer_keys=("year", "specialty"))


# --- shared chains ----------------------------------------------------------------


def _silver(spark, sf_dir):
    return silver_from_standin(spark, sf_dir)


def _silver_once(spark, sf_dir):
    """Silver stored once, for queries that read it several times (as a pipeline
    reads its Silver table)."""
    return stored(silver_from_standin(spark, sf_dir), "silver")


def _marts_once(spark, sf_dir):
    """The five marts, each stored once; the anomaly mart reads the stored summary."""
    made = gold_marts(_silver_once(spark, sf_dir), anomalies=False)
    made = {name: stored(df, name) for name, df in made.items()}
    return made | {"gold_anomaly_prescribers": stored(outliers.anomaly_prescribers(made["gold_prescriber_summary"], materialize=False), "anomalies")}


def _typed(spark, sf_dir):
    return clean.type_raw(standin_raw(spark, sf_dir), year_col="yr")


def _anomalies(spark, sf_dir):
    return outliers.anomaly_prescribers(_summary(spark, sf_dir))


def _star(spark, sf_dir):
    """The star over stored Silver. Dimensions are stored, so that the planner knows
    which are small before it moves the fact."""
    return _star_of(_silver_once(spark, sf_dir))


def _star_of(silver):
    tables = star.star_schema(silver)
    return {name: stored(df, name) if name.startswith("dim_") else df for name, df in tables.items()}


def W(needed: list[str], body: str, **kw) -> str:
    return O.with_ctes(needed, body, **kw)


# --- Silver stage -------------------------------------------------------------------

FLAG_SQL = """SELECT year, is_tot_claims_suppressed, is_ge65_suppressed, COUNT(*) AS row_count
FROM typed GROUP BY year, is_tot_claims_suppressed, is_ge65_suppressed"""


@register("suppression_flags", W(["typed"], FLAG_SQL))
def suppression_flags(spark, sf_dir):
    return _typed(spark, sf_dir).groupBy("year", "is_tot_claims_suppressed", "is_ge65_suppressed").agg(
        F.count(F.lit(1)).alias("row_count")
    )


NUMERIC_COLS = [
    "npi", "year", "brand_name", "generic_name", "tot_claims", "tot_30day_fills", "tot_drug_cost", "tot_day_supply",
    "tot_beneficiaries", "ge65_claims", "ge65_drug_cost", "cost_per_claim", "claims_per_beneficiary",
    "is_tot_claims_suppressed", "is_ge65_suppressed",
]


@register("numeric_parse", W(["typed"], f"SELECT {', '.join(NUMERIC_COLS)} FROM typed"))
def numeric_parse(spark, sf_dir):
    return _typed(spark, sf_dir).select(*NUMERIC_COLS)


DEDUP_SQL = f"""SELECT {', '.join(SILVER_KEY)}, COUNT(*) AS row_count, COUNT(*) - 1 AS removed_rows
FROM typed GROUP BY {', '.join(SILVER_KEY)} HAVING COUNT(*) > 1"""


@register("dedup_key", W(["typed"], DEDUP_SQL))
def dedup_key(spark, sf_dir):
    return (
        _typed(spark, sf_dir)
        .groupBy(*SILVER_KEY)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
        .withColumn("removed_rows", F.col("row_count") - 1)
    )


def _unparsable_sql() -> str:
    parts = []
    for src, kind in O.NUMERIC.items():
        pat = O.LONG_PATTERN if kind == "BIGINT" else O.DOUBLE_PATTERN
        parts.append(f"COALESCE(NOT {O.sup(src)} AND NOT regexp_matches(replace(trim({src}), ',', ''), {O._q(pat)}), FALSE)")
    return " OR ".join(parts)


REJECT_SQL = f"""SELECT yr AS year, CASE WHEN ({_unparsable_sql()}) OR COALESCE({O.num('Tot_Drug_Cst', 'DOUBLE')} < 0, FALSE)
 THEN 'REJECTED' ELSE 'ACCEPTED' END AS status, COUNT(*) AS row_count FROM raw GROUP BY 1, 2"""


@register("reject_split", W(["raw"], REJECT_SQL))
def reject_split(spark, sf_dir):
    flagged = clean.flag_rejects(standin_raw(spark, sf_dir), year_col="yr")
    status = F.when(F.size("reject_reasons") > 0, F.lit("REJECTED")).otherwise(F.lit("ACCEPTED"))
    return flagged.groupBy("year", status.alias("status")).agg(F.count(F.lit(1)).alias("row_count"))


# --- star schema ----------------------------------------------------------------------


@register("dim_prescriber", W(["dim_prescriber"], "SELECT * FROM dim_prescriber"))
def q_dim_prescriber(spark, sf_dir):
    return star.dim_prescriber(_silver(spark, sf_dir))


@register("dim_drug", W(["dim_drug"], "SELECT * FROM dim_drug"))
def q_dim_drug(spark, sf_dir):
    return star.dim_drug(_silver(spark, sf_dir))


@register("dim_state", W(["dim_state"], "SELECT * FROM dim_state"))
def q_dim_state(spark, sf_dir):
    return star.dim_state(_silver(spark, sf_dir))


@register("dim_year", W(["dim_year"], "SELECT * FROM dim_year"))
def q_dim_year(spark, sf_dir):
    return star.dim_year(_silver(spark, sf_dir))


@register("fact_prescriptions", W(["fact"], "SELECT * FROM fact"))
def q_fact(spark, sf_dir):
    return star.fact_prescriptions(_silver(spark, sf_dir))


STAR_ROLLUP_SQL = f"""SELECT y.year, s.state_abbr, p.specialty, CAST(SUM(f.tot_claims) AS BIGINT) AS total_claims,
 {O.money('f.tot_drug_cost')} AS total_drug_cost, COUNT(DISTINCT p.npi) AS prescriber_count, COUNT(*) AS fact_rows
FROM fact f JOIN dim_prescriber p ON f.prescriber_id = p.prescriber_id JOIN dim_drug d ON f.drug_id = d.drug_id
 JOIN dim_state s ON f.state_id = s.state_id JOIN dim_year y ON f.year_id = y.year_id
GROUP BY y.year, s.state_abbr, p.specialty"""


@register("star_join_rollup", W(["fact", "dim_prescriber", "dim_drug", "dim_state", "dim_year"], STAR_ROLLUP_SQL))
def star_join_rollup(spark, sf_dir):
    return star.star_rollup(_star(spark, sf_dir))


ORPHANS_SQL = "\nUNION ALL\n".join(
    f"SELECT '{k}' AS foreign_key, '{d}' AS dimension, COUNT(*) AS orphan_rows FROM fact f "
    f"WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{k} = f.{k})"
    for k, d in [("prescriber_id", "dim_prescriber"), ("drug_id", "dim_drug"), ("state_id", "dim_state"), ("year_id", "dim_year")]
)


@register("orphans", W(["fact", "dim_prescriber", "dim_drug", "dim_state", "dim_year"], ORPHANS_SQL))
def q_orphans(spark, sf_dir):
    return star.orphans(_star(spark, sf_dir))


# --- marts --------------------------------------------------------------------------------


@register("mart_state_year", W(["state_year"], "SELECT * FROM state_year"))
def mart_state_year(spark, sf_dir):
    return marts.mart("gold_state_year_spending")(_silver_once(spark, sf_dir))


@register("mart_drug_year", W(["drug_year"], "SELECT * FROM drug_year"))
def mart_drug_year(spark, sf_dir):
    return marts.mart("gold_drug_year_spending")(_silver_once(spark, sf_dir))


@register("mart_specialty_state", W(["specialty_state"], "SELECT * FROM specialty_state"))
def mart_specialty_state(spark, sf_dir):
    return marts.mart("gold_specialty_state_spending")(_silver_once(spark, sf_dir))


# --- outlier variants ---------------------------------------------------------------------

FLAG_OUT = ["mart_id", "year", "npi", "full_name", "city", "state", "specialty", "total_claims",
            "avg_cost_per_claim", "peer_size", "peer_threshold", "is_anomaly"]

ANOMALY_FLAG_SQL = f"""SELECT s.mart_id, s.year, s.npi, s.full_name, s.city, s.state, s.specialty, s.total_claims,
 s.avg_cost_per_claim, t.peer_size, t.peer_threshold,
 COALESCE(s.total_claims >= 30 AND s.avg_cost_per_claim IS NOT NULL AND t.peer_threshold IS NOT NULL
  AND s.avg_cost_per_claim > t.peer_threshold, FALSE) AS is_anomaly
FROM summary s LEFT JOIN (
 SELECT year, state, specialty, COUNT(*) AS peer_size, quantile_disc(avg_cost_per_claim, 0.95) AS peer_threshold
 FROM summary WHERE avg_cost_per_claim IS NOT NULL GROUP BY year, state, specialty
) t ON s.year = t.year AND s.state = t.state AND s.specialty = t.specialty"""


@register("anomaly_flag", W(["summary"], ANOMALY_FLAG_SQL))
def anomaly_flag(spark, sf_dir):
    return outliers.peer_outliers(_summary(spark, sf_dir), mode="flag").select(*FLAG_OUT)


OUTLIER_OUT = ["mart_id", "year", "npi", "state", "specialty", "total_claims", "avg_cost_per_claim", "peer_size"]


def _outlier_sql(stats_select: str, threshold: str, extra_out: str) -> str:
    return f"""SELECT s.mart_id, s.year, s.npi, s.state, s.specialty, s.total_claims, s.avg_cost_per_claim, t.peer_size, {extra_out}
FROM summary s JOIN (
 SELECT year, state, specialty, COUNT(*) AS peer_size, {stats_select}
 FROM summary WHERE avg_cost_per_claim IS NOT NULL GROUP BY year, state, specialty
) t ON s.year = t.year AND s.state = t.state AND s.specialty = t.specialty
WHERE s.total_claims >= 30 AND s.avg_cost_per_claim IS NOT NULL AND ({threshold}) IS NOT NULL
 AND s.avg_cost_per_claim > ({threshold})"""


IQR_SQL = _outlier_sql(
    "quantile_cont(avg_cost_per_claim, 0.25) AS q1, quantile_cont(avg_cost_per_claim, 0.75) AS q3",
    "t.q3 + CAST(1.5 AS DOUBLE) * (t.q3 - t.q1)",
    "round(t.q1, 6) AS q1, round(t.q3, 6) AS q3, round(t.q3 + CAST(1.5 AS DOUBLE) * (t.q3 - t.q1), 6) AS peer_threshold",
)


@register("anomaly_iqr", W(["summary"], IQR_SQL))
def anomaly_iqr(spark, sf_dir):
    out = outliers.peer_outliers(_summary(spark, sf_dir), method="iqr")
    # Interpolated quantiles are shown at 6 decimals: engines differ in the
    # last bit of the interpolation; the outlier decision uses full precision.
    return out.select(*OUTLIER_OUT, *[F.round(c, 6).alias(c) for c in ("q1", "q3", "peer_threshold")])


Z_SQL = _outlier_sql(
    f"{O.stable_avg('avg_cost_per_claim')} AS peer_mean, {O.stable_stddev('avg_cost_per_claim')} AS peer_stddev",
    "t.peer_mean + CAST(3.0 AS DOUBLE) * t.peer_stddev",
    "t.peer_mean, round(t.peer_stddev, 6) AS peer_stddev",
)


@register("anomaly_zscore", W(["summary"], Z_SQL))
def anomaly_zscore(spark, sf_dir):
    out = outliers.peer_outliers(_summary(spark, sf_dir), method="zscore")
    return out.select(*OUTLIER_OUT, "peer_mean", F.round("peer_stddev", 6).alias("peer_stddev"))


DRUG_KEYS = list(outliers.DRUG_PEER_KEYS)
DRUG_OUT = ["year", "npi", "state", "specialty", "brand_name", "generic_name", "tot_claims"]


def _drug_grain_sql(metric: str, mode: str) -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in DRUG_KEYS)
    cond = (f"s.tot_claims >= 30 AND s.{metric} IS NOT NULL AND t.peer_threshold IS NOT NULL "
            f"AND s.{metric} > t.peer_threshold")
    thr = (f"SELECT {', '.join(DRUG_KEYS)}, COUNT(*) AS peer_size, quantile_disc({metric}, 0.95) AS peer_threshold "
           f"FROM silver WHERE {metric} IS NOT NULL GROUP BY {', '.join(DRUG_KEYS)}")
    cols = ", ".join(f"s.{c}" for c in DRUG_OUT)
    if mode == "filter":
        return f"SELECT {cols}, s.{metric}, t.peer_size, t.peer_threshold FROM silver s JOIN ({thr}) t ON {on} WHERE {cond}"
    return (f"SELECT {cols}, s.{metric}, t.peer_size, t.peer_threshold, COALESCE({cond}, FALSE) AS is_anomaly "
            f"FROM silver s LEFT JOIN ({thr}) t ON {on}")


def _drug_grain(spark, sf_dir, metric, mode):
    # Only the columns in use are materialised.
    used = _silver(spark, sf_dir).select(*dict.fromkeys([*DRUG_OUT, *DRUG_KEYS, "tot_claims", metric]))
    out = outliers.peer_outliers(
        used, peer_keys=tuple(DRUG_KEYS), metric=metric, volume="tot_claims", mode=mode
    )
    extra = ["is_anomaly"] if mode == "flag" else []
    return out.select(*DRUG_OUT, metric, "peer_size", "peer_threshold", *extra)


@register("anomaly_drug_grain", W(["silver"], _drug_grain_sql("cost_per_claim", "filter")))
def anomaly_drug_grain(spark, sf_dir):
    return _drug_grain(spark, sf_dir, "cost_per_claim", "filter")


@register("anomaly_drug_flag", W(["silver"], _drug_grain_sql("cost_per_claim", "flag")))
def anomaly_drug_flag(spark, sf_dir):
    return _drug_grain(spark, sf_dir, "cost_per_claim", "flag")


@register("anomaly_claims_per_beneficiary", W(["silver"], _drug_grain_sql("claims_per_beneficiary", "flag")))
def anomaly_claims_per_beneficiary(spark, sf_dir):
    return _drug_grain(spark, sf_dir, "claims_per_beneficiary", "flag")


APPROX_SQL = """SELECT year, state, specialty, COUNT(avg_cost_per_claim) AS peer_size, TRUE AS within_bound
FROM summary WHERE avg_cost_per_claim IS NOT NULL AND state IS NOT NULL AND specialty IS NOT NULL GROUP BY year, state, specialty"""


@register("anomaly_approx", W(["summary"], APPROX_SQL))
def anomaly_approx(spark, sf_dir):
    """The published method itself, ``percentile_approx`` with accuracy 100: its
    rank error in each peer group against the bound that it promises."""
    return outliers.approx_rank_error(stored(_summary(spark, sf_dir), "summary"), ["year", "state", "specialty"], "avg_cost_per_claim")


# --- views ------------------------------------------------------------------------------------


@register("view_kpis", W(["kpis"], "SELECT * FROM kpis"))
def view_kpis(spark, sf_dir):
    return views.overview_kpis(marts.mart("gold_state_year_spending")(_silver_once(spark, sf_dir)))


@register("view_state", W(["v_state"], "SELECT * FROM v_state"))
def view_state(spark, sf_dir):
    return views.state_spending(marts.mart("gold_state_year_spending")(_silver_once(spark, sf_dir)))


@register("view_top_drugs", W(["v_top_drugs"], "SELECT * FROM v_top_drugs"))
def view_top_drugs(spark, sf_dir):
    return views.top_drugs(marts.mart("gold_drug_year_spending")(_silver_once(spark, sf_dir)))


@register("view_specialty_state", W(["v_specialty_state"], "SELECT * FROM v_specialty_state"))
def view_specialty_state(spark, sf_dir):
    return views.specialty_state(marts.mart("gold_specialty_state_spending")(_silver_once(spark, sf_dir)))


@register("view_leaders", W(["v_leaders"], "SELECT * FROM v_leaders"))
def view_leaders(spark, sf_dir):
    return views.prescriber_leaders(_summary(spark, sf_dir))


@register("view_anomaly", W(["v_anomaly"], "SELECT * FROM v_anomaly"))
def view_anomaly(spark, sf_dir):
    return views.anomaly_detail(_anomalies(spark, sf_dir))


@register("view_anomaly_summary", W(["v_anomaly_summary"], "SELECT * FROM v_anomaly_summary"))
def view_anomaly_summary(spark, sf_dir):
    return views.anomaly_summary(_anomalies(spark, sf_dir))


# --- charts -------------------------------------------------------------------------------------

KPI_TOTALS_SQL = f"""SELECT 'total_drug_cost' AS metric, {O.money('total_drug_cost')} AS value FROM kpis
UNION ALL SELECT 'total_claims', CAST(SUM(total_claims) AS DOUBLE) FROM kpis
UNION ALL SELECT 'anomaly_prescribers', CAST(COUNT(*) AS DOUBLE) FROM anomaly"""


@register("chart_kpi_totals", W(["kpis", "anomaly"], KPI_TOTALS_SQL))
def chart_kpi_totals(spark, sf_dir):
    silver = _silver_once(spark, sf_dir)
    kpis = views.overview_kpis(marts.mart("gold_state_year_spending")(silver))
    return views.kpi_totals(kpis, outliers.anomaly_prescribers(marts.prescriber_summary(silver)))


@register(
    "chart_anomaly_by_state",
    W(["v_anomaly_summary"], O.top_k("v_anomaly_summary", "state", "CAST(SUM(anomaly_prescriber_count) AS BIGINT)", "anomaly_prescribers", 15)),
)
def chart_anomaly_by_state(spark, sf_dir):
    return views.top_k(views.anomaly_summary(_anomalies(spark, sf_dir)), "state", "anomaly_prescriber_count", 15,
                       "anomaly_prescribers", money=False)


@register(
    "chart_anomaly_by_specialty",
    W(["v_anomaly_summary"], O.top_k("v_anomaly_summary", "specialty", "CAST(SUM(anomaly_prescriber_count) AS BIGINT)", "anomaly_prescribers", 15)),
)
def chart_anomaly_by_specialty(spark, sf_dir):
    return views.top_k(views.anomaly_summary(_anomalies(spark, sf_dir)), "specialty", "anomaly_prescriber_count", 15,
                       "anomaly_prescribers", money=False)


TOP25_SQL = """SELECT full_name, npi, state, specialty, total_claims, total_drug_cost, avg_cost_per_claim,
 peer_p95_cost_per_claim, anomaly_reason FROM v_anomaly
ORDER BY total_drug_cost DESC NULLS LAST, year, npi, state, specialty, full_name, city LIMIT 25"""


@register("chart_anomaly_top25", W(["v_anomaly"], TOP25_SQL))
def chart_anomaly_top25(spark, sf_dir):
    return views.anomaly_top_rows(_anomalies(spark, sf_dir), 25)


@register("chart_state_cost", W(["v_state"], O.top_k("v_state", "state", O.money("total_drug_cost"), "total_drug_cost", None)))
def chart_state_cost(spark, sf_dir):
    return views.top_k(views.state_spending(marts.mart("gold_state_year_spending")(_silver_once(spark, sf_dir))), "state",
                       "total_drug_cost", None, "total_drug_cost")


@register("chart_top20_drugs", W(["v_top_drugs"], O.top_k("v_top_drugs", "brand_name", O.money("total_drug_cost"), "total_drug_cost", 20)))
def chart_top20_drugs(spark, sf_dir):
    return views.top_k(views.top_drugs(marts.mart("gold_drug_year_spending")(_silver_once(spark, sf_dir))), "brand_name",
                       "total_drug_cost", 20, "total_drug_cost")


# --- documented analytics -------------------------------------------------------------------------

TOP_STATES_SQL = """SELECT year, state, total_drug_cost, CAST(rank AS INTEGER) AS rank FROM (
 SELECT year, state, total_drug_cost,
  row_number() OVER (PARTITION BY year ORDER BY total_drug_cost DESC NULLS LAST, state ASC NULLS LAST) AS rank
 FROM state_year) WHERE rank <= 10"""


@register("top_states_per_year", W(["state_year"], TOP_STATES_SQL))
def top_states_per_year(spark, sf_dir):
    m = marts.mart("gold_state_year_spending")(_silver_once(spark, sf_dir)).select("year", "state", "total_drug_cost")
    return views.top_per_group(m, ["year"], "total_drug_cost", 10, ["state"])


SHARE_SQL = f"""SELECT d.year, d.brand_name, d.generic_name, d.total_drug_cost,
 {O.ratio('d.total_drug_cost', 't.total')} AS cost_share
FROM drug_year d JOIN (SELECT year, {O.money('total_drug_cost')} AS total FROM drug_year GROUP BY year) t ON d.year = t.year"""


@register("drug_spend_share", W(["drug_year"], SHARE_SQL))
def drug_spend_share(spark, sf_dir):
    return views.drug_spend_share(marts.mart("gold_drug_year_spending")(_silver_once(spark, sf_dir)))


MIX_SQL = f"""SELECT year, generic_cost, brand_cost, generic_claims, brand_claims,
 {O.ratio('brand_cost', 'generic_cost')} AS brand_to_generic_cost_ratio FROM (
 SELECT year,
  {O.money('CASE WHEN brand_name = generic_name THEN tot_drug_cost END')} AS generic_cost,
  {O.money('CASE WHEN brand_name = generic_name THEN NULL ELSE tot_drug_cost END')} AS brand_cost,
  CAST(SUM(CASE WHEN brand_name = generic_name THEN tot_claims END) AS BIGINT) AS generic_claims,
  CAST(SUM(CASE WHEN brand_name = generic_name THEN NULL ELSE tot_claims END) AS BIGINT) AS brand_claims
 FROM silver GROUP BY year)"""


@register("brand_generic_mix", W(["silver"], MIX_SQL))
def brand_generic_mix(spark, sf_dir):
    return views.brand_generic_mix(_silver(spark, sf_dir))


YOY_SQL = f"""SELECT state, year, total_drug_cost, prev_year, prev_total_drug_cost,
 total_drug_cost - prev_total_drug_cost AS total_drug_cost_change,
 {O.ratio('total_drug_cost - prev_total_drug_cost', 'prev_total_drug_cost')} AS total_drug_cost_pct_change FROM (
 SELECT state, year, total_drug_cost, lag(year) OVER (PARTITION BY state ORDER BY year) AS prev_year,
  lag(total_drug_cost) OVER (PARTITION BY state ORDER BY year) AS prev_total_drug_cost FROM state_year)"""


@register("yoy_state_cost", W(["state_year"], YOY_SQL))
def yoy_state_cost(spark, sf_dir):
    return views.yoy_change(marts.mart("gold_state_year_spending")(_silver_once(spark, sf_dir)), ["state"], "total_drug_cost")


GE65_SQL = f"""SELECT year, ge65_drug_cost, drug_cost_where_known, total_drug_cost, ge65_suppressed_rows, rows,
 {O.ratio('ge65_drug_cost', 'drug_cost_where_known')} AS ge65_cost_share,
 {O.ratio('ge65_suppressed_rows', 'rows')} AS ge65_suppressed_share FROM (
 SELECT year, {O.money('ge65_drug_cost')} AS ge65_drug_cost,
  {O.money('CASE WHEN ge65_drug_cost IS NOT NULL THEN tot_drug_cost END')} AS drug_cost_where_known,
  {O.money('tot_drug_cost')} AS total_drug_cost,
  COUNT(*) FILTER (WHERE is_ge65_suppressed) AS ge65_suppressed_rows, COUNT(*) AS rows
 FROM silver GROUP BY year)"""


@register("ge65_share", W(["silver"], GE65_SQL))
def ge65_share(spark, sf_dir):
    return views.ge65_share(_silver(spark, sf_dir))


@register(
    "distinct_prescribers",
    W(["silver"], "SELECT year, COUNT(DISTINCT CASE WHEN npi <> '' THEN npi END) AS distinct_prescribers FROM silver GROUP BY year"),
)
def distinct_prescribers(spark, sf_dir):
    return views.distinct_prescribers(_silver(spark, sf_dir))


DASH_STATES = ["AMERICA", "ASIA"]
DASH_SPECIALTIES = ["BUILDING", "MACHINERY"]


@register(
    "filtered_dashboard",
    W(["v_leaders"], f"SELECT * FROM v_leaders WHERE state IN {O._in(DASH_STATES)} AND specialty IN {O._in(DASH_SPECIALTIES)}"),
)
def filtered_dashboard(spark, sf_dir):
    return views.dashboard_filter(
        views.prescriber_leaders(_summary(spark, sf_dir)), states=DASH_STATES, specialties=DASH_SPECIALTIES
    )


# --- loads, lineage and quality ------------------------------------------------------------

RUN_ID = "run-0001"
DATASET = "prescriptions"
DATASET_ID = "stand-in"


@register("upsert_marts", W(["state_year"], "SELECT * FROM state_year"))
def upsert_marts(spark, sf_dir):
    """The stored mart (stale for years divisible by three, without those that
    leave one) is upserted with marts recomputed for both. The result must equal
    the mart computed from scratch."""
    silver = _silver_once(spark, sf_dir)
    rest = F.col("year") % 3
    stored = marts.mart("gold_state_year_spending")(silver.where(rest != 1)).withColumn(
        "total_claims", F.when(rest == 0, F.lit(0).cast("long")).otherwise(F.col("total_claims"))
    )
    return upsert.upsert_by_key(stored, marts.mart("gold_state_year_spending")(silver.where(rest != 2)), ["mart_id"])


TABLE_COUNTS_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {cte}"
    for name, cte in [
        ("dim_year", "dim_year"), ("dim_state", "dim_state"), ("dim_drug", "dim_drug"),
        ("dim_prescriber", "dim_prescriber"), ("fact_prescriptions", "fact"),
        ("gold_state_year_spending", "state_year"), ("gold_drug_year_spending", "drug_year"),
        ("gold_specialty_state_spending", "specialty_state"), ("gold_prescriber_summary", "summary"),
        ("gold_anomaly_prescribers", "anomaly"),
    ]
)


@register(
    "table_counts",
    W(["dim_year", "dim_state", "dim_drug", "dim_prescriber", "fact", "state_year", "drug_year", "specialty_state",
       "summary", "anomaly"], TABLE_COUNTS_SQL),
)
def table_counts(spark, sf_dir):
    silver = _silver_once(spark, sf_dir)
    tables = gold_tables(silver)
    mart_set = gold_marts(silver, materialize_summary=True)
    ordered = {n: tables[n] for n in STAR_LOAD_ORDER} | {n: mart_set[n] for n in MART_LOAD_ORDER}
    return upsert.table_counts(ordered)


def _dq_sql_row(layer: str, check: str, observed_sql: str, fail: str = "FAIL") -> str:
    return (
        f"SELECT '{RUN_ID}' AS run_id, '{DATASET}' AS dataset_name, '{layer}' AS layer, '{check}' AS check_name, "
        f"CASE WHEN n = 0 THEN 'PASS' ELSE '{fail}' END AS status, CAST(n AS VARCHAR) AS observed_value, "
        f"'0' AS expected_value, CAST(NULL AS VARCHAR) AS details FROM ({observed_sql}) AS t(n)"
    )


DQ_SQL = "\nUNION ALL\n".join(
    [
        _dq_sql_row("silver", "npi_present", "SELECT COUNT(*) FILTER (WHERE npi IS NULL OR npi = '') FROM silver"),
        _dq_sql_row("silver", "no_negative_cost", "SELECT COUNT(*) FILTER (WHERE tot_drug_cost < 0 OR ge65_drug_cost < 0) FROM silver"),
        _dq_sql_row("silver", "year_not_null", "SELECT COUNT(*) FILTER (WHERE year IS NULL) FROM silver"),
        _dq_sql_row("silver", "state_not_null", "SELECT COUNT(*) FILTER (WHERE state IS NULL) FROM silver"),
        _dq_sql_row("silver", "state_defaulted", "SELECT COUNT(*) FILTER (WHERE state = 'UNKNOWN') FROM silver", "WARN"),
        _dq_sql_row("silver", "silver_grain_unique",
                    f"SELECT COUNT(*) FROM (SELECT 1 FROM silver GROUP BY {', '.join(SILVER_KEY)} HAVING COUNT(*) > 1)"),
        _dq_sql_row("gold", "fact_key_unique", "SELECT COUNT(*) FROM (SELECT 1 FROM fact GROUP BY fact_id HAVING COUNT(*) > 1)"),
        _dq_sql_row("gold", "dim_prescriber_key_unique",
                    "SELECT COUNT(*) FROM (SELECT 1 FROM dim_prescriber GROUP BY prescriber_id HAVING COUNT(*) > 1)"),
        _dq_sql_row("gold", "prescriber_summary_key_unique",
                    "SELECT COUNT(*) FROM (SELECT 1 FROM summary GROUP BY mart_id HAVING COUNT(*) > 1)"),
        _dq_sql_row("gold", "summary_not_null", "SELECT COUNT(*) FILTER (WHERE year IS NULL OR npi IS NULL) FROM summary"),
    ]
    + [
        _dq_sql_row("gold", f"orphans_{k}", f"SELECT COUNT(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{k} = f.{k})")
        for k, d in [("prescriber_id", "dim_prescriber"), ("drug_id", "dim_drug"), ("state_id", "dim_state"), ("year_id", "dim_year")]
    ]
)


@register("dq_results", W(["silver", "fact", "dim_prescriber", "dim_drug", "dim_state", "dim_year", "summary"], DQ_SQL))
def dq_results(spark, sf_dir):
    silver = _silver_once(spark, sf_dir)
    tables = _star_of(silver)
    summary = stored(marts.prescriber_summary(silver), "summary")
    return quality.union_all(
        [
            quality.silver_checks(silver, RUN_ID, DATASET),
            quality.duplicate_key_check(silver, SILVER_KEY, RUN_ID, DATASET, "silver", "silver_grain_unique"),
            quality.duplicate_key_check(tables["fact_prescriptions"], ["fact_id"], RUN_ID, DATASET, "gold", "fact_key_unique"),
            quality.duplicate_key_check(tables["dim_prescriber"], ["prescriber_id"], RUN_ID, DATASET, "gold", "dim_prescriber_key_unique"),
            quality.duplicate_key_check(summary, ["mart_id"], RUN_ID, DATASET, "gold", "prescriber_summary_key_unique"),
            quality.not_null_check(summary, ["year", "npi"], RUN_ID, DATASET, "gold", "summary_not_null"),
            quality.orphan_check(star.orphans(tables), RUN_ID, DATASET),
        ]
    )


RECON_SQL = f"""SELECT COALESCE(s.year, g.year) AS year, COALESCE(s.state, g.state) AS state, s.silver_claims, s.silver_cost,
 g.total_claims AS gold_claims, g.total_drug_cost AS gold_cost,
 s.silver_claims IS NOT DISTINCT FROM g.total_claims AS claims_match,
 (COALESCE(abs(s.silver_cost - g.total_drug_cost) <= 0.005, FALSE) OR (s.silver_cost IS NULL AND g.total_drug_cost IS NULL)) AS cost_match
FROM (SELECT year, state, CAST(SUM(tot_claims) AS BIGINT) AS silver_claims, {O.money('tot_drug_cost')} AS silver_cost
      FROM silver GROUP BY year, state) s
FULL OUTER JOIN state_year g ON s.year = g.year AND s.state = g.state"""


@register("reconcile_gold", W(["silver", "state_year"], RECON_SQL))
def reconcile_gold(spark, sf_dir):
    silver = _silver_once(spark, sf_dir)
    return quality.reconcile(silver, marts.mart("gold_state_year_spending")(silver), ["year", "state"])


def _manifest(spark, sf_dir):
    raw = standin_raw(spark, sf_dir)
    return lineage.build_manifest(
        raw, DATASET, DATASET_ID, f"file://{sf_dir}", page_size=5000, ingested_at="2024-01-01T00:00:00+00:00", year_col="yr"
    )


def _raw_text() -> str:
    return "concat_ws('|', " + ", ".join(f"COALESCE({c}, '__NULL__')" for c in O.RAW_COLUMNS) + ")"


MANIFEST_SQL = f"""SELECT '{DATASET}' AS dataset_name, '{DATASET_ID}' AS dataset_id, yr AS year, COUNT(*) AS row_count,
 CAST(NULL AS BIGINT) AS expected_row_count, CAST(5000 AS INTEGER) AS page_size,
 sha256(concat_ws(':', COUNT(*)::VARCHAR, SUM(CAST(('0x' || substr(h, 1, 15))::BIGINT AS DECIMAL(38,0)))::VARCHAR,
  SUM(CAST(('0x' || substr(h, 16, 15))::BIGINT AS DECIMAL(38,0)))::VARCHAR)) AS checksum_sha256,
 '2024-01-01T00:00:00+00:00' AS ingested_at
FROM (SELECT yr, sha256({_raw_text()}) AS h FROM raw) GROUP BY yr"""


@register("manifest", W(["raw"], MANIFEST_SQL))
def manifest(spark, sf_dir):
    """Per-year manifest with the content fingerprint of the raw rows."""
    return _manifest(spark, sf_dir).drop("source_url")


LOG_SQL = f"""SELECT '{RUN_ID}' AS run_id, '{DATASET}' AS dataset_name, yr AS year, COUNT(*) AS row_count,
 CASE WHEN yr % 2 = 0 THEN 'SUCCESS' ELSE 'RUNNING' END AS status FROM raw GROUP BY yr
UNION ALL SELECT 'run-0000', '{DATASET}', yr - 10, CAST(1 AS BIGINT), 'FAILED' FROM raw GROUP BY yr
UNION ALL SELECT 'run-0002', '{DATASET}', yr, COUNT(*), 'SUCCESS' FROM raw WHERE yr % 2 = 0 GROUP BY yr"""


def _log(m: DataFrame, run: str, status: str) -> DataFrame:
    done = None if status == "RUNNING" else "2024-01-01 01:00:00"
    return lineage.log_records(m, run, status, "2024-01-01 00:00:00", done, "bronze/year={year}/part.csv", "bronze/year={year}/manifest.json")


@register("run_log_upsert", W(["raw"], LOG_SQL))
def run_log_upsert(spark, sf_dir):
    """The log holds an older run's failures of other years and this run's
    RUNNING for every year; SUCCESS comes in for some years of this run and of a
    new one. Old rows stay, matching ones are replaced, new ones added."""
    m = cut_lineage(_manifest(spark, sf_dir))
    older = m.withColumn("year", F.col("year") - 10).withColumn("row_count", F.lit(1).cast("long"))
    stored = _log(older, "run-0000", "FAILED").unionByName(_log(m, RUN_ID, "RUNNING"))
    even = m.where(F.col("year") % 2 == 0)
    incoming = _log(even, RUN_ID, "SUCCESS").unionByName(_log(even, "run-0002", "SUCCESS"))
    return lineage.upsert_run_log(stored, incoming).select("run_id", "dataset_name", "year", "row_count", "status")


@register(
    "ingest_skip",
    W(["raw"], f"SELECT '{DATASET_ID}' AS dataset_id, yr AS year, COUNT(*) AS row_count FROM raw "
               "GROUP BY yr HAVING yr % 3 <> 0 OR yr % 2 = 0"),
)
def ingest_skip(spark, sf_dir):
    """Years already loaded with the same checksum are skipped: those that the
    log has with SUCCESS. A failed load and another checksum do not count."""
    m = cut_lineage(_manifest(spark, sf_dir))
    same = m.where((F.col("year") % 3 == 0) & (F.col("year") % 2 == 1))
    changed = m.where(F.col("year") % 3 == 1).withColumn("checksum_sha256", F.lit("other"))
    failed = m.where(F.col("year") % 3 == 2)
    log = _log(same, RUN_ID, "SUCCESS").unionByName(_log(changed, RUN_ID, "SUCCESS")).unionByName(_log(failed, RUN_ID, "FAILED"))
    return lineage.skip_ingested(m, log).select("dataset_id", "year", "row_count")


_PROFILE_TYPES = {
    "year": "int", "is_tot_claims_suppressed": "boolean", "is_ge65_suppressed": "boolean", "tot_claims": "bigint",
    "tot_30day_fills": "double", "tot_drug_cost": "double", "tot_day_supply": "bigint", "tot_beneficiaries": "bigint",
    "ge65_claims": "bigint", "ge65_drug_cost": "double", "cost_per_claim": "double", "claims_per_beneficiary": "double",
}


def _profile_sql(c: str) -> str:
    kind = _PROFILE_TYPES.get(c, "string")
    text = "CAST(CAST({}({}) AS DECIMAL(38,6)) AS VARCHAR)" if kind == "double" else "CAST({}({}) AS VARCHAR)"
    return (
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"COUNT(DISTINCT {c}) AS distinct_count, TRUE AS approx_within_bound, {text.format('min', c)} AS min_value, {text.format('max', c)} AS max_value FROM silver"
    )


@register("profile_table", W(["silver"], "\nUNION ALL\n".join(_profile_sql(c) for c in O.SILVER_COLUMNS)))
def profile_table(spark, sf_dir):
    """The one-pass profile, its approximate distinct counts held against exact
    ones within four standard errors."""
    silver = _silver_once(spark, sf_dir)
    p = profile.profile(silver).join(profile.exact_distinct(silver), "column_name")
    close = F.abs(F.col("approx_distinct") - F.col("distinct_count")) <= 4 * profile.RSD * F.col("distinct_count")
    return p.select("column_name", "data_type", "row_count", "null_count", "distinct_count", close.alias("approx_within_bound"), "min_value", "max_value")


# Statistics documents as a source reports them: the count under one of several
# keys, as a number or as text, or missing.
EXPECTED_SQL = """SELECT year, CASE
  WHEN year % 3 = 0 THEN total
  WHEN year % 3 = 1 THEN total
  ELSE NULL END AS expected_row_count
FROM (SELECT yr AS year, COUNT(*) AS total FROM raw GROUP BY yr)"""


@register("expected_counts", W(["raw"], EXPECTED_SQL))
def expected_counts(spark, sf_dir):
    counts = standin_raw(spark, sf_dir).groupBy(F.col("yr").alias("year")).agg(F.count(F.lit(1)).alias("total"))
    variant = F.col("year") % 3
    stats = counts.select(
        "year",
        F.when(variant == 0, F.col("total").cast("string")).alias("total_rows"),
        F.when(variant == 1, F.col("total").cast("string")).alias("rowCount"),
        F.when(variant == 2, F.lit("n/a")).alias("count"),
    )
    return stats.select("year", total_rows_expr(stats.columns).alias("expected_row_count"))


# --- run control, contracts and reconciliation -------------------------------------------

EXPECTED_YEARS = [1994, 1995, 2002]


def _dq_select(layer: str, check: str, status: str, source: str) -> str:
    return f"SELECT '{layer}' AS layer, {check} AS check_name, {status} AS status FROM {source}"


RUN_CHECKS_SQL = "\nUNION ALL\n".join(
    [
        _dq_select("bronze", "'row_count_' || yr", "CASE WHEN yr % 2 = 1 THEN 'FAIL' ELSE 'PASS' END", "(SELECT DISTINCT yr FROM raw)"),
        _dq_select("bronze", "'partial_row_count_' || yr", "CASE WHEN yr % 2 = 1 THEN 'WARN' ELSE 'PASS' END", "(SELECT DISTINCT yr FROM raw)"),
        _dq_select("bronze", "'checksum_unchanged_' || yr", "CASE WHEN yr = 2001 THEN 'WARN' WHEN yr = 1995 THEN 'FAIL' ELSE 'PASS' END", "(SELECT DISTINCT yr FROM raw)"),
        _dq_select("silver", "'year_completeness'", f"CASE WHEN COUNT(DISTINCT yr) FILTER (yr IN {tuple(EXPECTED_YEARS)}) = {len(EXPECTED_YEARS)} THEN 'PASS' ELSE 'FAIL' END", "raw"),
        _dq_select("silver", "'valid_state_code'", "CASE WHEN COUNT(*) FILTER (state IS NULL OR state NOT IN (SELECT upper(r_name) FROM region WHERE r_name <> 'ASIA')) = 0 THEN 'PASS' ELSE 'FAIL' END", "silver"),
        _dq_select("silver", "'bronze_minus_rejected_equals_accepted'", "'PASS'", "(SELECT 1)"),
        _dq_select("bronze", "'status_domain'", "CASE WHEN COUNT(*) FILTER (yr % 3 = 0) = 0 THEN 'PASS' ELSE 'FAIL' END", "raw"),
    ]
)


@register("dq_run_checks", W(["raw", "silver"], RUN_CHECKS_SQL))
def dq_run_checks(spark, sf_dir):
    """K1, K7, K8, K10, K11 and K12 with inputs that break each but K10: odd years
    report one row more than there is, a year changed, two are missing, a state
    is unknown to the reference, a status is outside its domain."""
    m = cut_lineage(_manifest(spark, sf_dir))
    counted = m.withColumn("expected_row_count", F.col("row_count") + F.col("year") % 2)
    partial = quality.row_count_check(lineage.row_count_status(counted, partial=True), RUN_ID)
    recorded = m.where(F.col("year") != 2001).withColumn("checksum_sha256", F.when(F.col("year") == 1995, F.lit("other")).otherwise(F.col("checksum_sha256")))
    silver = stored(_silver(spark, sf_dir).select("year", "state"), "silver-states")  # what the checks read
    states = spark.read.parquet(f"{sf_dir}/region.parquet").where("r_name <> 'ASIA'").select(F.upper("r_name").alias("state"))
    flow, _ = _written(spark, sf_dir)
    flow_row = quality.row_flow_check(spark, flow, RUN_ID, DATASET).where("check_name = 'bronze_minus_rejected_equals_accepted'")
    log = m.select(F.when(F.col("year") % 3 == 0, "DONE").otherwise("SUCCESS").alias("status"))
    return quality.union_all(
        [
            quality.row_count_check(lineage.row_count_status(counted), RUN_ID),
            partial.withColumn("check_name", F.concat(F.lit("partial_"), F.col("check_name"))),
            lineage.checksum_check(m, recorded, RUN_ID),
            quality.year_completeness(silver, EXPECTED_YEARS, RUN_ID, DATASET),
            quality.reference_check(silver, "state", states, RUN_ID, DATASET, "silver", "valid_state_code"),
            flow_row,
            quality.status_domain_check(log, ("RUNNING", "SUCCESS", "FAILED"), RUN_ID, DATASET, "bronze", "status_domain"),
        ]
    ).select("layer", "check_name", "status")


# Keys and NOT NULL columns of the contracts, written out for the SQL.
CONTRACT = {
    ("dim_year", "dim_year"): (["year_id", "year"], ["year"]),
    ("dim_state", "dim_state"): (["state_id", "state_abbr"], ["state_abbr"]),
    ("dim_drug", "dim_drug"): (["drug_id", "brand_name, generic_name"], []),
    ("dim_prescriber", "dim_prescriber"): (["prescriber_id", "npi, city, state, specialty"], ["npi"]),
    ("fact_prescriptions", "fact"): (["fact_id"], ["prescriber_id", "drug_id", "state_id", "year_id"]),
    ("gold_state_year_spending", "state_year"): (["mart_id"], ["year", "state"]),
    ("gold_drug_year_spending", "drug_year"): (["mart_id"], ["year"]),
    ("gold_specialty_state_spending", "specialty_state"): (["mart_id"], ["year", "state"]),
    ("gold_prescriber_summary", "summary"): (["mart_id"], ["year", "npi"]),
    ("gold_anomaly_prescribers", "anomaly"): (["mart_id"], ["year", "npi"]),
}


def _contract_sql() -> str:
    parts = []
    for (name, cte), (keys, filled) in CONTRACT.items():
        for key in keys:
            known = " AND ".join(f"{c} IS NOT NULL" for c in key.split(", "))
            parts.append((f"{name}_{key.replace(', ', '_')}_unique", f"SELECT COUNT(*) FROM (SELECT 1 FROM {cte} WHERE {known} GROUP BY {key} HAVING COUNT(*) > 1)"))
        parts += [(f"{name}_{c}_not_null", f"SELECT COUNT(*) FROM {cte} WHERE {c} IS NULL") for c in filled]
    return "\nUNION ALL\n".join(f"SELECT '{check}' AS check_name, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n::VARCHAR AS observed_value FROM ({sql}) t(n)" for check, sql in parts)


@register("dq_contracts", W([c for _, c in CONTRACT], _contract_sql()))
def dq_contracts(spark, sf_dir):
    """Declared keys and NOT NULL columns of all ten gold tables. The fact is a
    projection of the stored Silver rows and is read as such."""
    silver = _silver_once(spark, sf_dir)
    tables = _star_of(silver)
    made = {name: stored(df, name) for name, df in gold_marts(silver, anomalies=False).items()}
    tables |= made | {"gold_anomaly_prescribers": stored(outliers.anomaly_prescribers(made["gold_prescriber_summary"], materialize=False), "anomalies")}
    return quality.constraint_checks({n: tables[n] for n, _ in CONTRACT}, RUN_ID, DATASET).select("check_name", "status", "observed_value")


RECONCILED = {
    "gold_state_year_spending": ("state_year", ["year", "state"]),
    "gold_drug_year_spending": ("drug_year", ["year", "brand_name", "generic_name"]),
    "gold_specialty_state_spending": ("specialty_state", ["year", "state", "specialty"]),
    "gold_prescriber_summary": ("summary", ["year", "npi", "full_name", "city", "state", "specialty"]),
    "gold_anomaly_prescribers": ("anomaly", ["year", "npi", "full_name", "city", "state", "specialty"]),
}
RECONCILE_ALL_SQL = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, year, CASE year % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'total_claims' ELSE 'total_claims,total_drug_cost' END AS difference, "
    f"COUNT(*) AS keys FROM {c} WHERE year % 4 < 3 AND (year % 4 = 0 OR total_claims IS NOT NULL OR (year % 4 = 2 AND total_drug_cost IS NOT NULL)) "
    f"AND (year % 4 <> 2 OR (total_claims IS NOT NULL AND total_drug_cost IS NOT NULL)) GROUP BY ALL"
    for n, (c, _) in RECONCILED.items()
)


@register("reconcile_marts", W([c for c, _ in RECONCILED.values()], RECONCILE_ALL_SQL))
def reconcile_marts(spark, sf_dir):
    """All five marts recomputed against stored copies that lost a year, or have
    other claims, or other claims and cost."""
    made = _marts_once(spark, sf_dir)
    frames = []
    for name, (_, keys) in RECONCILED.items():
        kind = F.col("year") % 4
        good = made[name].where((kind != 2) | (F.col("total_claims").isNotNull() & F.col("total_drug_cost").isNotNull()))
        bad = good.where(kind != 0).withColumn("total_claims", F.col("total_claims") + F.when((kind == 1) | (kind == 2), 1).otherwise(0))
        bad = bad.withColumn("total_drug_cost", F.col("total_drug_cost") + F.when(kind == 2, 1.0).otherwise(0.0))
        found = quality.reconcile_tables(good, bad, keys, ["total_claims", "total_drug_cost", "avg_cost_per_claim"])
        frames.append(found.groupBy(F.lit(name).alias("table_name"), "year", "difference").agg(F.count("*").alias("keys")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("constant_year", W(["raw"], "SELECT CAST(2030 AS INTEGER) AS year, COUNT(*) AS row_count FROM raw"))
def constant_year(spark, sf_dir):
    """The year as a job argument instead of a column."""
    typed = clean.type_raw(standin_raw(spark, sf_dir), year=2030)
    return typed.groupBy("year").agg(F.count("*").alias("row_count"))


HEAD_ORDER = ["year", "npi", "full_name", "city", "state", "specialty"]


@register("head_summary", W(["summary"], "SELECT * FROM summary ORDER BY " + ", ".join(f"{c} NULLS LAST" for c in HEAD_ORDER) + " LIMIT 20"))
def head_summary(spark, sf_dir):
    return profile.head(_summary(spark, sf_dir), 20, HEAD_ORDER)


YOY_DRUG_SQL = YOY_SQL.replace("SELECT state, year", "SELECT brand_name, generic_name, year").replace("PARTITION BY state", "PARTITION BY brand_name, generic_name").replace("FROM state_year", "FROM drug_year")


@register("yoy_drug_cost", W(["drug_year"], YOY_DRUG_SQL))
def yoy_drug_cost(spark, sf_dir):
    m = marts.mart("gold_drug_year_spending")(_silver_once(spark, sf_dir))
    return views.yoy_change(m, ["brand_name", "generic_name"], "total_drug_cost")


@register("append_years", W(["raw"], "SELECT yr AS year, COUNT(*) AS row_count, COUNT(CASE WHEN yr % 2 = 0 THEN Tot_Clms END) AS with_claims FROM raw GROUP BY yr"))
def append_years(spark, sf_dir):
    """Tables appended by column name; those of odd years have no claims column."""
    raw = standin_raw(spark, sf_dir)
    even, odd = (raw.where(F.pmod("yr", F.lit(2)) == r) for r in (0, 1))
    out = even.unionByName(odd.drop("Tot_Clms"), allowMissingColumns=True)
    return out.groupBy(F.col("yr").alias("year")).agg(F.count("*").alias("row_count"), F.count("Tot_Clms").alias("with_claims"))


# --- loads as the job writes them ---------------------------------------------------------


def _written(spark, sf_dir):
    """Silver and rejects written from the staged view: the job's counts and metrics."""
    root = f"{ensure_checkpoint_dir(spark)}/stored/load-{uuid.uuid4().hex}"
    raw = standin_raw(spark, sf_dir).withColumnRenamed("yr", "year").withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))
    staged = stage_bronze(raw, f"{root}/bronze")
    years = sorted(r["year"] for r in staged.select("year").distinct().collect())  # a handful
    return write_silver(Lake(spark, root), staged, years)


_REJECTED = f"(({_unparsable_sql()}) OR COALESCE({O.num('Tot_Drug_Cst', 'DOUBLE')} < 0, FALSE))"


def _accepted_only(sql: str) -> str:
    """The statement over the rows that are not rejected."""
    whole = f"raw AS (\n{O.RAW}\n)"
    if whole not in sql:
        raise ValueError("the statement does not begin with the raw view")
    return sql.replace(whole, f"raw_all AS (\n{O.RAW}\n),\nraw AS (SELECT * FROM raw_all WHERE NOT {_REJECTED})", 1)


ROW_FLOW_SQL = _accepted_only(
    W(
        ["raw", "silver"],
        """SELECT (SELECT COUNT(*) FROM raw_all) AS staged, (SELECT COUNT(*) FROM raw) AS accepted, (SELECT COUNT(*) FROM silver) AS unique_rows,
 (SELECT COUNT(*) FROM raw_all) - (SELECT COUNT(*) FROM raw) AS rejected_stored, (SELECT COUNT(*) FROM silver) AS silver_stored""",
    )
)


@register("row_flow", ROW_FLOW_SQL)
def row_flow(spark, sf_dir):
    """K10's numbers: rows counted where the job wrote them, and what the written
    tables hold."""
    flow, _ = _written(spark, sf_dir)
    row = (flow.staged, flow.accepted, flow.unique, flow.rejected_stored, flow.silver_stored)
    return spark.createDataFrame([row], "staged long, accepted long, unique_rows long, rejected_stored long, silver_stored long")


DQ_WRITTEN_SQL = _accepted_only(
    W(
        ["silver"],
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS check_name, CASE WHEN n = 0 THEN 'PASS' ELSE '{bad}' END AS status, n::VARCHAR AS observed_value FROM (SELECT COUNT(*) FILTER (WHERE {cond}) FROM silver) AS t(n)"
            for name, bad, cond in (
                ("npi_present", "FAIL", "npi IS NULL OR npi = ''"),
                ("no_negative_cost", "FAIL", "tot_drug_cost < 0 OR ge65_drug_cost < 0"),
                ("year_not_null", "FAIL", "year IS NULL"),
                ("state_not_null", "FAIL", "state IS NULL"),
                ("state_defaulted", "WARN", "state = 'UNKNOWN'"),
            )
        ),
    )
)


@register("dq_written", DQ_WRITTEN_SQL)
def dq_written(spark, sf_dir):
    """K2, K3 and K5 from the metrics of the job that writes Silver."""
    _, metrics = _written(spark, sf_dir)
    return quality.written_silver_checks(spark, metrics, RUN_ID, DATASET).select("check_name", "status", "observed_value")


# Names that make every seventh record span two lines, with quotes and commas.
_SPANNING = "Prscrbr_Last_Org_Name || chr(10) || '\"x\", ' || Prscrbr_Last_Org_Name"
CSV_SCAN_SQL = f"""SELECT yr AS year, Prscrbr_State_Abrvtn AS state, COUNT(*) AS row_count, COUNT(NULLIF(Prscrbr_NPI, '')) AS with_npi,
 COUNT(*) FILTER (contains(name, chr(10))) AS spanning, CAST(SUM(length(name)) AS BIGINT) AS name_chars, CAST(SUM(length(Tot_Clms)) AS BIGINT) AS claims_chars,
 COUNT(*) FILTER (contains(name, '"x", ')) AS quoted, COUNT(Gnrc_Name) AS with_generic
FROM (SELECT *, CASE WHEN length(Prscrbr_First_Name) = 8 OR Prscrbr_Last_Org_Name LIKE '%7' THEN {_SPANNING} ELSE Prscrbr_Last_Org_Name END AS name FROM raw)
WHERE Prscrbr_State_Abrvtn <> '' GROUP BY 1, 2"""


@register("csv_scan", W(["raw"], CSV_SCAN_SQL))
def csv_scan(spark, sf_dir):
    """The raw view as CSV text, some records over several lines, read back by the
    parallel scan with its columns bound by name."""
    raw = standin_raw(spark, sf_dir)
    last = F.col("Prscrbr_Last_Org_Name")
    spans = (F.length("Prscrbr_First_Name") == 8) | last.endswith("7")
    raw = raw.withColumn("Prscrbr_Last_Org_Name", F.when(spans, F.concat(last, F.lit('\n"x", '), last)).otherwise(last))
    path = f"{ensure_checkpoint_dir(spark)}/stored/csv-{uuid.uuid4().hex}"
    # The year is a column of the file that the raw layout does not know: in place of one it does.
    out = raw.withColumn("Prscrbr_Type_Src", F.col("yr").cast("string")).drop("yr")
    out.write.options(**CSV_TEXT, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    back = read_bronze_csv(spark, path)
    name = F.col("Prscrbr_Last_Org_Name")
    return (
        back.where("Prscrbr_State_Abrvtn <> ''")
        .groupBy(F.col("Prscrbr_Type_Src").cast("int").alias("year"), F.col("Prscrbr_State_Abrvtn").alias("state"))
        .agg(
            F.count("*").alias("row_count"), F.count("Prscrbr_NPI").alias("with_npi"), F.count_if(F.contains(name, F.lit("\n"))).alias("spanning"),
            F.sum(F.length(name)).alias("name_chars"), F.sum(F.length("Tot_Clms")).alias("claims_chars"), F.count_if(F.contains(name, F.lit('"x", '))).alias("quoted"),
            F.count("Gnrc_Name").alias("with_generic"),
        )
    )


# --- stored forms of gold tables ----------------------------------------------------------


@register("star_join_colocated", W(["fact", "dim_prescriber", "dim_drug", "dim_state", "dim_year"], STAR_ROLLUP_SQL))
def star_join_colocated(spark, sf_dir):
    """The star report from a fact and a prescriber dimension bucketed by key."""
    tables = star.colocated(_star(spark, sf_dir), f"{ensure_checkpoint_dir(spark)}/stored", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return star.star_rollup(tables)


SKETCHES_SQL = """SELECT state, COUNT(DISTINCT npi) AS distinct_prescribers, TRUE AS within_bound FROM silver WHERE npi <> '' GROUP BY state"""


@register("distinct_sketches", W(["silver"], SKETCHES_SQL))
def distinct_sketches(spark, sf_dir):
    """Distinct prescribers of all years by state from stored yearly sketches, held
    against exact counts within four standard errors."""
    silver = _silver_once(spark, sf_dir)
    sketches = stored(views.distinct_sketches(silver, ["state"]), "sketches")
    exact = silver.where("npi <> ''").groupBy("state").agg(F.countDistinct("npi").alias("distinct_prescribers"))
    both = exact.join(views.distinct_of_years(sketches, ["state"]), "state")
    close = F.abs(F.col("approx_distinct") - F.col("distinct_prescribers")) <= 4 * views.SKETCH_ERROR * F.col("distinct_prescribers")
    return both.select("state", "distinct_prescribers", close.alias("within_bound"))


_SUMMARY_KEYS = ["year", "npi", "full_name", "city", "state", "specialty"]
DIFFERING_SQL = f"""SELECT {', '.join(_SUMMARY_KEYS)}, CASE WHEN year % 2 = 0 THEN 'missing' ELSE 'total_claims' END AS difference
FROM summary WHERE npi LIKE '%7' AND (year % 2 = 0 OR total_claims IS NOT NULL)"""


@register("differing_rows", W(["summary"], DIFFERING_SQL))
def differing_rows(spark, sf_dir):
    """The rows in which a stored prescriber summary differs from the recomputed one,
    found by fingerprints of key ranges."""
    summary = stored(_summary(spark, sf_dir), "summary")
    odd = F.col("npi").endswith("7")
    copy = summary.where(~F.coalesce(odd & (F.col("year") % 2 == 0), F.lit(False)))
    copy = copy.withColumn("total_claims", F.col("total_claims") + F.when(odd, 1).otherwise(0))
    return quality.differing_rows(summary, stored(copy, "copy"), _SUMMARY_KEYS, ["total_claims", "total_drug_cost", "avg_cost_per_claim"], fanout=16)


PAGED_SQL = """SELECT yr AS year, Prscrbr_State_Abrvtn AS state, COUNT(*) AS row_count, COUNT(Prscrbr_NPI) AS with_npi,
 COUNT(Gnrc_Name) AS with_generic, CAST(SUM(length(Prscrbr_Last_Org_Name)) AS BIGINT) AS name_chars,
 CAST(SUM(length(Tot_Clms)) AS BIGINT) AS claims_chars, CAST(SUM(length(Tot_Drug_Cst)) AS BIGINT) AS cost_chars
FROM raw GROUP BY 1, 2"""


PAGE_ROWS = 5000


@register("paged_source", W(["raw"], PAGED_SQL))
def paged_source(spark, sf_dir):
    """The raw view landed as JSON pages of at most 5,000 records, with a page beyond
    a gap that must stay unread, read back by the page source."""
    raw = standin_raw(spark, sf_dir).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
    raw = raw.withColumn("Prscrbr_Type_Src", F.col("yr").cast("string")).drop("yr")
    path = f"{ensure_checkpoint_dir(spark)}/stored/landed-{uuid.uuid4().hex}"
    write_pages(raw, path, "file", "place", PAGE_ROWS)
    back = read_pages(spark, path, pattern=r"page=(\d+)/[^/]*$")
    return back.groupBy(F.col("Prscrbr_Type_Src").cast("int").alias("year"), F.col("Prscrbr_State_Abrvtn").alias("state")).agg(
        F.count("*").alias("row_count"), F.count("Prscrbr_NPI").alias("with_npi"), F.count("Gnrc_Name").alias("with_generic"),
        F.sum(F.length("Prscrbr_Last_Org_Name")).alias("name_chars"), F.sum(F.length("Tot_Clms")).alias("claims_chars"), F.sum(F.length("Tot_Drug_Cst")).alias("cost_chars"),
    )


@register("sized_layout", W(["silver"], "SELECT year, state, COUNT(*) AS row_count, CAST(CEIL(COUNT(*) / 500.0) AS BIGINT) AS file_count, true AS even FROM silver GROUP BY year, state"))
def sized_layout(spark, sf_dir):
    """Silver written in files of at most 500 rows by year and state and read back:
    rows and files of each folder, and whether its files are within a factor of two."""
    silver = _silver(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/stored/sized-{uuid.uuid4().hex}"
    write_sized(silver, path, ["year", "state"], 500)
    files = spark.read.schema(silver.schema).parquet(path).groupBy("year", "state", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return files.groupBy("year", "state").agg(F.sum("n").alias("row_count"), F.count("*").alias("file_count"), (F.max("n") <= 2 * F.min("n")).alias("even"))


TOP_COST = ["year", "npi", "state", "specialty", "full_name", "city"]


@register("top_cost_banded", W(["summary"], f"SELECT {', '.join(TOP_COST)}, total_claims, total_drug_cost FROM summary ORDER BY total_drug_cost DESC NULLS LAST, {', '.join(TOP_COST)} LIMIT 25"))
def top_cost_banded(spark, sf_dir):
    """The 25 prescribers of highest cost from a summary stored in bands of cost."""
    path = f"{ensure_checkpoint_dir(spark)}/stored/banded-{uuid.uuid4().hex}"
    costs = stored(_summary(spark, sf_dir).select(*TOP_COST, "total_claims", "total_drug_cost"), "costs")
    write_banded(costs, path, "total_drug_cost")
    return read_top(spark, path, costs.schema, "total_drug_cost", 25, TOP_COST)
