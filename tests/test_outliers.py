"""Peer thresholds and outliers; exact quantiles against Spark's own aggregates."""

import random

import pytest
from pyspark.sql import functions as F

from rxlake.operators import outliers


@pytest.fixture(scope="module")
def skewed(spark):
    random.seed(7)
    rows = []
    # One hot group with a third of all rows and many ties, plus many small groups.
    for i in range(3000):
        rows.append(("hot", float(random.choice([1.0, 2.0, 2.5, 3.0]) if i % 3 else random.uniform(0, 100))))
    for g in range(200):
        for _ in range(random.randint(1, 30)):
            rows.append((f"g{g}", round(random.uniform(0, 50), 2)))
    rows.append(("nulls", None))
    return spark.createDataFrame(rows, "k string, v double")


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_group_quantiles_equal_exact_builtins(spark, skewed, accuracy):
    got = outliers.group_quantiles(
        skewed, ["k"], "v", {"p95": (0.95, "disc"), "p50": (0.5, "disc"), "q1": (0.25, "cont"), "q3": (0.75, "cont")},
        accuracy,
    )
    want = skewed.where(F.col("v").isNotNull()).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY v)").alias("p95"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("p50"),
        F.percentile("v", 0.25).alias("q1"),
        F.percentile("v", 0.75).alias("q3"),
    )
    g = {r["k"]: r for r in got.collect()}
    w = {r["k"]: r for r in want.collect()}
    assert set(g) == set(w)
    for k in w:
        assert g[k]["n"] == w[k]["n"]
        assert g[k]["p95"] == w[k]["p95"] and g[k]["p50"] == w[k]["p50"], k
        assert g[k]["q1"] == pytest.approx(w[k]["q1"], rel=1e-12) and g[k]["q3"] == pytest.approx(w[k]["q3"], rel=1e-12)


def exact_p95(df):
    exact = F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY v)")
    return {r["k"]: r["p95"] for r in df.where(F.col("v").isNotNull()).groupBy("k").agg(exact.alias("p95")).collect()}


def test_split_points_far_from_the_rank_cost_passes_only(spark, skewed, monkeypatch):
    # A grid of two steps and a careless sketch: ranges shrink slowly, results stay.
    monkeypatch.setattr(outliers, "GRID", 2)
    got = {r["k"]: r["p95"] for r in outliers.group_quantiles(skewed, ["k"], "v", {"p95": (0.95, "disc")}, 3).collect()}
    assert got == exact_p95(skewed)


def test_a_group_of_a_million_distinct_values_takes_few_passes(spark, monkeypatch):
    big = spark.range(1_200_000, numPartitions=8).select(F.when(F.col("id") % 6 > 0, "hot").otherwise("b").alias("k"), F.exp(F.col("id") / 3000.0).alias("v"))
    passes, real = [], outliers._narrow

    def counted(base, ranges, *args):
        passes.append(1)
        return real(base, ranges, *args)

    monkeypatch.setattr(outliers, "_narrow", counted)
    found = outliers.group_quantiles(big, ["k"], "v", {"p95": (0.95, "disc"), "m": (0.5, "cont")})
    got = {r["k"]: r["p95"] for r in found.collect()}
    assert got == exact_p95(big)
    assert len(passes) <= 5
    # Nothing is ordered or gathered by value: no window, no sort of values.
    assert "Window" not in found._jdf.queryExecution().toString()


def test_two_values_around_the_rank(spark):
    rows = [("a", 1.0)] * 500 + [("a", 2.0)] * 500 + [(None, float("inf"))] * 3 + [(None, -1.0)] * 3
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["n"], r["d"], r["c"]) for r in outliers.group_quantiles(df, ["k"], "v", {"d": (0.5, "disc"), "c": (0.5, "cont")}).collect()}
    assert got["a"] == (1000, 1.0, 1.5) and got[None][:2] == (6, -1.0)


def summary_rows(spark, n, claims=40, specialty="X"):
    rows = [(2022, "CA", specialty, f"p{i}", claims, float(i + 1)) for i in range(n)]
    return spark.createDataFrame(rows, "year int, state string, specialty string, npi string, total_claims long, avg_cost_per_claim double")


def test_small_peer_groups_flag_nobody(spark):
    assert outliers.peer_outliers(summary_rows(spark, 19)).count() == 0
    # 20 distinct peers: the threshold is the 19th value, so only the top one is above it.
    assert outliers.peer_outliers(summary_rows(spark, 20)).count() == 1


def test_volume_threshold(spark):
    base = summary_rows(spark, 40)
    top = base.withColumn("total_claims", F.when(F.col("npi") == "p39", F.lit(29)).otherwise(F.col("total_claims")))
    flagged = {r["npi"] for r in outliers.peer_outliers(top).collect()}
    assert "p39" not in flagged and "p38" in flagged
    top30 = base.withColumn("total_claims", F.lit(30).cast("long"))
    assert "p39" in {r["npi"] for r in outliers.peer_outliers(top30).collect()}


def test_null_specialty_never_matches(spark):
    df = summary_rows(spark, 40, specialty=None)
    assert outliers.peer_outliers(df).count() == 0
    flagged = outliers.peer_outliers(df, mode="flag")
    assert flagged.count() == 40 and flagged.where("is_anomaly").count() == 0


def test_flag_mode_matches_filter_mode(spark):
    df = summary_rows(spark, 60).unionByName(summary_rows(spark, 45, specialty="Y"))
    filtered = {r["npi"] + r["specialty"] for r in outliers.peer_outliers(df).collect()}
    flagged = {r["npi"] + r["specialty"] for r in outliers.peer_outliers(df, mode="flag").where("is_anomaly").collect()}
    assert filtered == flagged and len(filtered) > 0


def test_iqr_and_zscore(spark):
    df = summary_rows(spark, 50).unionByName(
        spark.createDataFrame([(2022, "CA", "X", "big", 100, 1000.0)], summary_rows(spark, 1).schema)
    )
    assert [r["npi"] for r in outliers.peer_outliers(df, method="iqr").collect()] == ["big"]
    assert [r["npi"] for r in outliers.peer_outliers(df, method="zscore").collect()] == ["big"]


def test_approx_method_is_a_group_member(spark, skewed):
    t = outliers.approx_group_quantiles(skewed, ["k"], "v", {"p": 0.95}, 100)
    members = skewed.select("k", F.col("v").alias("p")).distinct()
    assert t.join(members, ["k", "p"], "left_anti").count() == 0
