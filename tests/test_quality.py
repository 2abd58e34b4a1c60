"""Each data-quality check with a passing and a failing input."""

from dataclasses import replace

from helpers import silver_df, silver_row
from pyspark.sql import functions as F

from rxlake.operators import quality


def statuses(df):
    return {r["check_name"]: r["status"] for r in df.collect()}


def test_silver_checks_pass_and_fail(spark):
    good = silver_df(spark, [silver_row("1", "A", "CA", "X", "B", "G", 1, 1.0)])
    bad = silver_df(spark, [silver_row("", "A", "UNKNOWN", "X", "B", "G", 1, -1.0)])
    assert set(statuses(quality.silver_checks(good, "r")).values()) == {"PASS"}
    s = statuses(quality.silver_checks(bad, "r", valid_states=["CA"]))
    assert s["npi_present"] == "FAIL" and s["no_negative_cost"] == "FAIL"
    assert s["state_defaulted"] == "WARN" and s["valid_state_code"] == "FAIL"


def test_year_completeness(spark):
    s = silver_df(spark, [silver_row("1", "A", "CA", "X", "B", "G", 1, 1.0)])
    ok = quality.year_completeness(s, [2031], "r", "d").collect()[0]
    bad = quality.year_completeness(s, [2029, 2030, 2031], "r", "d").collect()[0]
    assert ok["status"] == "PASS" and bad["status"] == "FAIL" and bad["details"] == "missing years: 2029,2030"


def test_not_null_and_row_flow(spark):
    s = silver_df(spark, [silver_row("1", "A", "CA", "X", "B", "G", 1, 1.0), silver_row(None, "A", "CA", "X", "B", "G", 1, 1.0)])
    assert quality.not_null_check(s, ["npi"], "r", "d", "gold", "nn").collect()[0]["status"] == "FAIL"
    good = quality.RowFlow(staged=9, accepted=7, unique=6, rejected_stored=2, silver_stored=6)
    assert set(statuses(quality.row_flow_check(spark, good, "r", "d")).values()) == {"PASS"}
    lost = {r["check_name"]: (r["status"], r["observed_value"], r["expected_value"]) for r in quality.row_flow_check(spark, replace(good, rejected_stored=1, silver_stored=4), "r", "d").collect()}
    assert lost == {"bronze_minus_rejected_equals_accepted": ("FAIL", "1", "0"), "silver_written_equals_unique": ("FAIL", "4", "6")}


def test_reconcile_detects_differences(spark):
    from rxlake.operators import marts

    s = silver_df(spark, [silver_row("1", "A", "CA", "X", "B", "G", 10, 10.0), silver_row("2", "A", "NY", "X", "B", "G", 5, 1.0)])
    mart = marts.mart("gold_state_year_spending")(s)
    assert statuses(quality.reconcile_check(quality.reconcile(s, mart, ["year", "state"]), "r", "d", "recon"))["recon"] == "PASS"
    stale = mart.where("state = 'CA'")
    assert statuses(quality.reconcile_check(quality.reconcile(s, stale, ["year", "state"]), "r", "d", "recon"))["recon"] == "FAIL"


def test_head_with_an_order(spark):
    from rxlake.operators import profile

    df = spark.createDataFrame([(3, "c"), (None, "a"), (1, "b")], "k int, v string")
    assert [r["v"] for r in profile.head(df, 2, ["k"]).collect()] == ["b", "c"]
    assert profile.head(df, 2).count() == 2


def test_one_changed_row_is_found_without_joining_all(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("id", "IF(id % 7 = 0, NULL, id % 11) AS k", "CAST(id AS DOUBLE) / 3 AS v")
    other = rows.where("id <> 77").withColumn("v", F.expr("CASE id WHEN 1234 THEN -1.0 WHEN 70 THEN NULL ELSE v + 0.0001 END")).union(spark.sql("SELECT 99999L, NULL, 1.0D"))
    joined, real = [], quality.reconcile_tables

    def seen(a, b, *args):
        joined.append((a.count(), b.count()))
        return real(a, b, *args)

    monkeypatch.setattr(quality, "reconcile_tables", seen)
    exact = rows.withColumn("v", F.col("v") + 0.0001)
    found = {r["id"]: r["difference"] for r in quality.differing_rows(exact, other, ["id", "k"], ["v"], fanout=32).collect()}
    assert found == {77: "missing", 1234: "v", 70: "v", 99999: "unexpected"}
    assert joined[0][0] < 50 and joined[0][1] < 50
    # Within the tolerance: fingerprints differ everywhere, rows do not.
    assert quality.differing_rows(rows, exact, ["id", "k"], ["v"], fanout=4, levels=2).count() == 0


def test_a_sound_key_check_moves_hashes_alone(spark):
    from rxlake.operators import quality as q

    long = spark.range(200).selectExpr("concat('a long key of many characters ', id) AS key")
    check = q.duplicate_key_check(long, ["key"], "r", "d", "gold", "key_unique")
    assert "_hash" in check._jdf.queryExecution().optimizedPlan().toString()
    assert check.first()["status"] == "PASS"
    twice = long.union(long.where("key LIKE '% 7'"))
    row = q.duplicate_key_check(twice, ["key"], "r", "d", "gold", "key_unique").first()
    assert (row["status"], row["observed_value"]) == ("FAIL", "1")


def test_equal_hashes_of_different_keys_are_no_duplicates(spark, monkeypatch):
    from pyspark.sql import functions as F

    from rxlake.operators import quality as q
    from rxlake.operators import repeats

    same = lambda keys: F.pmod(F.xxhash64(*keys), F.lit(2))
    monkeypatch.setattr(repeats, "key_hash", same)
    monkeypatch.setattr(q, "key_hash", same)
    rows = spark.createDataFrame([("a", None), ("a", 1), ("b", 1), ("a", None), ("c", 1)], "x string, y int")
    row = q.duplicate_key_check(rows, ["x", "y"], "r", "d", "gold", "key_unique").first()
    assert (row["status"], row["observed_value"]) == ("FAIL", "1")
