"""The stand-in reaches both sides of every rule, and the profile its bounds."""

from pyspark.sql import functions as F

from rxlake.operators import profile
from rxlake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_rules_have_rows_on_both_sides(spark):
    rejects = {(r["status"]): r["row_count"] for r in QUERIES["reject_split"](spark, SF).groupBy("status").agg(F.sum("row_count").alias("row_count")).collect()}
    assert rejects["REJECTED"] > 0 and rejects["ACCEPTED"] > 0
    orphans = {r["foreign_key"]: r["orphan_rows"] for r in QUERIES["orphans"](spark, SF).collect()}
    assert orphans["prescriber_id"] > 0 and orphans["drug_id"] == 0
    mix = QUERIES["brand_generic_mix"](spark, SF).first()
    assert mix["generic_cost"] > 0 and mix["brand_to_generic_cost_ratio"] > 0
    assert QUERIES["anomaly_drug_grain"](spark, SF).count() > 0
    typed = QUERIES["numeric_parse"](spark, SF)
    assert typed.where("tot_claims IS NULL AND NOT is_tot_claims_suppressed").count() > 0
    assert typed.where("tot_drug_cost < 0").count() > 0
    silver = QUERIES["silver_clean"](spark, SF)
    assert silver.where("ge65_suppression_flag = 'Y'").count() > 0
    assert silver.where("npi = ''").count() > 0 and silver.where("npi IS NULL").count() > 0
    dq = {r["check_name"]: r["status"] for r in QUERIES["dq_results"](spark, SF).collect()}
    assert {"npi_present", "no_negative_cost", "prescriber_summary_key_unique", "summary_not_null", "orphans_prescriber_id"} <= {k for k, v in dq.items() if v == "FAIL"}
    assert dq["state_defaulted"] == "WARN"


def test_profile_reads_each_row_once(spark, capsys):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("d"), F.when(F.col("id") > 5, 1.5).alias("x"))
    rows = {r["column_name"]: r for r in profile.profile(df).collect()}
    assert rows["x"]["null_count"] == 6 and rows["x"]["max_value"] == "1.500000" and rows["d"]["approx_distinct"] == 10
    assert {r["column_name"]: r["distinct_count"] for r in profile.exact_distinct(df).collect()} == {"id": 1000, "d": 10, "x": 1}
    profile.profile(df).explain()
    assert "Expand" not in capsys.readouterr().out
