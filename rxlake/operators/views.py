"""Dashboard views, chart queries and the documented analytics on the marts.

Views relabel blank text at read time; charts re-aggregate a view and keep the
top k with a total tie-break so the cut is deterministic. Shares of a total use
an aggregate joined back (the totals table has one row per year) rather than a
window over the whole year, so no year is gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.functions.cleaning import default_blank, safe_divide
from rxlake.functions.money import money_sum, stable_avg
from rxlake.schemas import VIEW_COLUMNS, VIEW_LABELS


def _view(df: DataFrame, name: str) -> DataFrame:
    """The columns of a view, blank or missing labels as UNKNOWN."""
    return df.select(*[default_blank(c).alias(c) if c in VIEW_LABELS else F.col(c) for c in VIEW_COLUMNS[name]])


# --- views --------------------------------------------------------------------


def overview_kpis(state_year: DataFrame) -> DataFrame:
    """Per-year totals. The two count columns add per-state distinct counts, so a
    prescriber active in two states is counted twice (their names say so); see
    ``distinct_prescribers`` for the true count."""
    g = state_year.groupBy("year").agg(
        F.sum("total_claims").alias("total_claims"),
        money_sum("total_drug_cost").alias("total_drug_cost"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        F.sum("prescriber_count").alias("state_prescriber_count_sum"),
        F.sum("drug_count").alias("state_drug_count_sum"),
    )
    avg = F.when(F.col("total_claims") == 0, F.lit(None).cast("double")).otherwise(
        F.col("total_drug_cost") / F.col("total_claims").cast("double")
    )
    return g.withColumn("avg_cost_per_claim", avg)


def state_spending(state_year: DataFrame) -> DataFrame:
    return _view(state_year, "state_spending")


def top_drugs(drug_year: DataFrame) -> DataFrame:
    return _view(drug_year, "top_drugs")


def specialty_state(specialty_state_mart: DataFrame) -> DataFrame:
    return _view(specialty_state_mart, "specialty_state")


def prescriber_leaders(summary: DataFrame) -> DataFrame:
    return _view(summary, "prescriber_leaders")


def anomaly_detail(anomalies: DataFrame) -> DataFrame:
    return _view(anomalies, "anomaly_detail")


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.withColumn("specialty", default_blank("specialty"))
        .groupBy("year", "state", "specialty")
        .agg(
            F.count(F.lit(1)).alias("anomaly_prescriber_count"),
            F.sum("total_claims").alias("anomaly_total_claims"),
            money_sum("total_drug_cost").alias("anomaly_total_drug_cost"),
            stable_avg("avg_cost_per_claim").alias("anomaly_avg_cost_per_claim"),
            stable_avg("peer_p95_cost_per_claim").alias("peer_p95_cost_per_claim"),
        )
    )


# --- dashboard filter -----------------------------------------------------------


def dashboard_filter(
    df: DataFrame,
    years: list[int] | None = None,
    states: list[str] | None = None,
    specialties: list[str] | None = None,
) -> DataFrame:
    """Native dashboard filters; on a Parquet table partitioned by year/state
    these become partition filters and prune whole folders."""
    cond: Column = F.lit(True)
    if years:
        cond = cond & F.col("year").isin(*years)
    if states:
        cond = cond & F.col("state").isin(*states)
    if specialties:
        cond = cond & F.col("specialty").isin(*specialties)
    return df.where(cond)


# --- charts -------------------------------------------------------------------


def top_k(df: DataFrame, by: str, metric: str, k: int | None, alias: str, money: bool = True) -> DataFrame:
    """``SUM(metric)`` per ``by`` sorted descending (ties by ``by``), first k."""
    agg = money_sum(metric) if money else F.sum(metric)
    out = df.groupBy(by).agg(agg.alias(alias)).orderBy(F.col(alias).desc_nulls_last(), F.col(by).asc_nulls_last())
    return out.limit(k) if k else out


def kpi_totals(kpis: DataFrame, anomalies: DataFrame) -> DataFrame:
    """The three headline numbers as (metric, value) rows."""
    totals = kpis.agg(
        money_sum("total_drug_cost").alias("total_drug_cost"),
        F.sum("total_claims").cast("double").alias("total_claims"),
    )
    cost = totals.select(F.lit("total_drug_cost").alias("metric"), F.col("total_drug_cost").alias("value"))
    claims = totals.select(F.lit("total_claims").alias("metric"), F.col("total_claims").alias("value"))
    count = anomalies.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("anomaly_prescribers").alias("metric"), "value"
    )
    return cost.unionByName(claims).unionByName(count)


def anomaly_top_rows(anomalies: DataFrame, k: int = 25) -> DataFrame:
    """Highest-cost anomaly rows (a sorted top-k, planned as TakeOrderedAndProject)."""
    view = anomaly_detail(anomalies)
    order = [F.col("total_drug_cost").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ("year", "npi", "state", "specialty", "full_name", "city")
    ]
    return view.orderBy(*order).limit(k).select(
        "full_name", "npi", "state", "specialty", "total_claims", "total_drug_cost",
        "avg_cost_per_claim", "peer_p95_cost_per_claim", "anomaly_reason",
    )


def top_per_group(df: DataFrame, group: list[str], metric: str, k: int, tie: list[str]) -> DataFrame:
    """Top k rows per group by ``metric`` (``row_number() <= k``; Spark plans a
    WindowGroupLimit that trims each group before the shuffle)."""
    w = Window.partitionBy(*group).orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# --- documented analytics -------------------------------------------------------


def share_of_total(df: DataFrame, group: list[str], metric: str, alias: str = "share") -> DataFrame:
    """``metric / SUM(metric) per group`` via an aggregate joined back."""
    totals = df.groupBy(*group).agg(money_sum(metric).alias("_group_total"))
    return df.join(totals, group).withColumn(alias, safe_divide(metric, "_group_total")).drop("_group_total")


def drug_spend_share(drug_year: DataFrame) -> DataFrame:
    return share_of_total(
        drug_year.select("year", "brand_name", "generic_name", "total_drug_cost"), ["year"], "total_drug_cost", "cost_share"
    )


def brand_generic_mix(silver: DataFrame) -> DataFrame:
    """Per year: cost and claims of rows whose brand name equals the generic name
    (our definition of "generic"; the source has no such flag) vs the rest."""
    generic = F.col("brand_name") == F.col("generic_name")
    g = silver.groupBy("year").agg(
        money_sum(F.when(generic, F.col("tot_drug_cost"))).alias("generic_cost"),
        money_sum(F.when(~generic | generic.isNull(), F.col("tot_drug_cost"))).alias("brand_cost"),
        F.sum(F.when(generic, F.col("tot_claims"))).alias("generic_claims"),
        F.sum(F.when(~generic | generic.isNull(), F.col("tot_claims"))).alias("brand_claims"),
    )
    return g.withColumn("brand_to_generic_cost_ratio", safe_divide("brand_cost", "generic_cost"))


def yoy_change(df: DataFrame, entity: list[str], metric: str) -> DataFrame:
    """Year-over-year change of ``metric`` per entity (``lag`` over the entity's
    years; a partition holds one row per year)."""
    w = Window.partitionBy(*entity).orderBy("year")
    prev = F.lag(metric).over(w)
    return (
        df.select(*entity, "year", metric)
        .withColumn("prev_year", F.lag("year").over(w))
        .withColumn(f"prev_{metric}", prev)
        .withColumn(f"{metric}_change", F.col(metric) - F.col(f"prev_{metric}"))
        .withColumn(f"{metric}_pct_change", safe_divide(f"{metric}_change", f"prev_{metric}"))
    )


def ge65_share(silver: DataFrame) -> DataFrame:
    """Per year: share of cost from patients 65+ (over rows where it is known)
    and the share of rows whose 65+ values are suppressed."""
    known = F.col("ge65_drug_cost").isNotNull()
    g = silver.groupBy("year").agg(
        money_sum("ge65_drug_cost").alias("ge65_drug_cost"),
        money_sum(F.when(known, F.col("tot_drug_cost"))).alias("drug_cost_where_known"),
        money_sum("tot_drug_cost").alias("total_drug_cost"),
        F.count_if(F.col("is_ge65_suppressed")).alias("ge65_suppressed_rows"),
        F.count(F.lit(1)).alias("rows"),
    )
    return g.withColumn("ge65_cost_share", safe_divide("ge65_drug_cost", "drug_cost_where_known")).withColumn(
        "ge65_suppressed_share", safe_divide("ge65_suppressed_rows", "rows")
    )


def distinct_prescribers(silver: DataFrame, approx: bool = False) -> DataFrame:
    """True distinct prescribers per year (``approx`` uses a HyperLogLog sketch)."""
    npi = F.when(F.col("npi") != "", F.col("npi"))
    count = F.approx_count_distinct(npi) if approx else F.countDistinct(npi)
    return silver.groupBy("year").agg(count.alias("distinct_prescribers"))


#: Binary logarithm of a distinct sketch's registers: a standard error of 0.83 / 2**6.
SKETCH_BITS = 12
SKETCH_ERROR = 0.83 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(silver: DataFrame, grain: list[str], member: str = "npi") -> DataFrame:
    """A stored sketch of the distinct members of each year and ``grain``: a few
    kilobytes, however many members; blank ones are none."""
    known = silver.where(F.col(member) != "")
    return known.groupBy("year", *grain).agg(F.hll_sketch_agg(member, SKETCH_BITS).alias("members"))


def distinct_of_years(sketches: DataFrame, grain: list[str], years: list[int] | None = None) -> DataFrame:
    """Approximate distinct members of any union of years, from sketches alone (sums
    of the marts' yearly counts would count a member once a year)."""
    some = sketches if years is None else sketches.where(F.col("year").isin(years))
    return some.groupBy(*grain).agg(F.hll_sketch_estimate(F.hll_union_agg("members")).alias("approx_distinct"))
