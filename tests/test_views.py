"""Views, charts and analytics on small marts."""

from helpers import silver_df, silver_row
from pyspark.sql import functions as F

from rxlake.functions.cleaning import safe_divide
from rxlake.operators import views


def state_year(spark):
    rows = [
        (2021, "CA", 10, 100.0, 5, 2, 1), (2022, "CA", 20, 300.0, 5, 3, 1),
        (2021, "NY", 10, 200.0, 5, 2, 1), (2022, "NY", 0, 0.0, 5, 1, 1), (2022, "TX", 5, 300.0, 5, 1, 1),
    ]
    df = spark.createDataFrame(
        rows, "year int, state string, total_claims long, total_drug_cost double, total_beneficiaries long, prescriber_count long, drug_count long"
    )
    return df.withColumn("avg_cost_per_claim", safe_divide("total_drug_cost", "total_claims"))


def test_kpis_sum_states_per_year(spark):
    k = {r["year"]: r for r in views.overview_kpis(state_year(spark)).collect()}
    assert k[2022]["total_claims"] == 25 and k[2022]["total_drug_cost"] == 600.0
    assert k[2022]["state_prescriber_count_sum"] == 5 and k[2022]["avg_cost_per_claim"] == 24.0


def test_top_k_breaks_ties_by_key(spark):
    out = views.top_k(state_year(spark), "state", "total_drug_cost", 2, "cost").collect()
    assert [(r["state"], r["cost"]) for r in out] == [("CA", 400.0), ("TX", 300.0)]
    tied = spark.createDataFrame([("B", 1.0), ("A", 1.0), ("C", 0.5)], "state string, total_drug_cost double")
    assert [r["state"] for r in views.top_k(tied, "state", "total_drug_cost", 1, "cost").collect()] == ["A"]


def test_share_of_total_sums_to_one(spark):
    s = views.share_of_total(state_year(spark), ["year"], "total_drug_cost", "share")
    sums = {r["year"]: r["s"] for r in s.groupBy("year").agg(F.sum("share").alias("s")).collect()}
    assert all(abs(v - 1.0) < 1e-12 for v in sums.values())


def test_yoy_change(spark):
    y = {(r["state"], r["year"]): r for r in views.yoy_change(state_year(spark), ["state"], "total_drug_cost").collect()}
    assert y[("CA", 2022)]["total_drug_cost_change"] == 200.0 and y[("CA", 2022)]["total_drug_cost_pct_change"] == 2.0
    assert y[("CA", 2021)]["prev_total_drug_cost"] is None
    assert y[("TX", 2022)]["prev_year"] is None


def test_top_per_group(spark):
    out = views.top_per_group(state_year(spark), ["year"], "total_drug_cost", 1, ["state"]).collect()
    assert sorted((r["year"], r["state"]) for r in out) == [(2021, "NY"), (2022, "CA")]


def test_dashboard_filter(spark):
    df = state_year(spark)
    assert views.dashboard_filter(df, years=[2022], states=["CA", "TX"]).count() == 2
    assert views.dashboard_filter(df).count() == 5


def test_dashboard_filter_prunes_partitions(spark, tmp_dir, capsys):
    from rxlake.sources.files import read_parquet_table, write_partitioned_parquet

    write_partitioned_parquet(state_year(spark), tmp_dir + "/t")
    df = views.dashboard_filter(read_parquet_table(spark, tmp_dir + "/t"), years=[2022], states=["CA"])
    df.select("total_drug_cost").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in plan and "state" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert "ReadSchema: struct<total_drug_cost:double>" in plan
    assert [r[0] for r in df.select("total_drug_cost").collect()] == [300.0]


def test_distinct_members_of_unions_of_years(spark):
    rows = [silver_row(str(i), "A", "CA" if i % 2 else "NY", "X", "B", "G", 1, 1.0, year=y) for y in (2030, 2031) for i in range(3000 if y == 2030 else 2000)]
    silver = silver_df(spark, [*rows, silver_row("", "A", "CA", "X", "B", "G", 1, 1.0)])
    sketches = views.distinct_sketches(silver, ["state"])
    for years, want in ((None, 1500), ([2031], 1000), ([2030], 1500)):
        got = {r["state"]: r["approx_distinct"] for r in views.distinct_of_years(sketches, ["state"], years).collect()}
        assert set(got) == {"CA", "NY"}
        assert all(abs(n - want) <= 4 * views.SKETCH_ERROR * want for n in got.values())
