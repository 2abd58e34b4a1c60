"""The whole job: raw CSV per year -> Silver -> Gold -> exports, quality, manifest."""

import os

import pytest
from pyspark.sql import functions as F

from rxlake.operators import clean
from rxlake.plans.pipeline import run_pipeline
from rxlake.sources.bronze import read_bronze_years
from rxlake.sources.standin import standin_raw

SF = "/root/testdata/sf0.001"


def test_pipeline_round_trip(spark, tmp_dir):
    raw = standin_raw(spark, SF)
    years = sorted(r[0] for r in raw.select("yr").distinct().collect())
    paths = {}
    for y in years[:3]:
        p = os.path.join(tmp_dir, f"bronze/year={y}")
        raw.where(F.col("yr") == y).drop("yr").coalesce(1).write.option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(p)
        paths[y] = p
    bronze = read_bronze_years(spark, paths)
    out = os.path.join(tmp_dir, "out")
    first = run_pipeline(spark, bronze.where(F.col("year") == years[0]), out, "run-1", expected_years=years[:1])
    assert {r[0] for r in first["silver"].select("year").distinct().collect()} == {years[0]}
    result = run_pipeline(spark, bronze.where(F.col("year") != years[0]), out, "run-2", expected_years=years[:3])
    # The second load added years and kept the first.
    assert {r[0] for r in result["silver"].select("year").distinct().collect()} == set(years[:3])
    statuses = {(r["run_id"], r["check_name"]): r["status"] for r in result["quality"].collect()}
    assert statuses[("run-2", "orphans_prescriber_id")] == "FAIL"  # blank ids of the stand-in
    assert statuses[("run-2", "reconcile_state_year")] == "PASS"
    assert statuses[("run-2", "year_completeness")] == "PASS"
    assert statuses[("run-2", "bronze_minus_rejected_equals_accepted")] == "PASS"
    # The stored Silver equals Silver computed directly from the accepted rows.
    expected = clean.dedup_by_key(clean.split_rejects(bronze)[0])
    got = result["silver"].select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert os.path.isdir(os.path.join(out, "exports", "gold_anomaly_prescribers"))
    # Incremental Gold equals Gold built from scratch over the same Silver.
    from rxlake.plans.pipeline import gold_marts, gold_tables

    full = {**gold_tables(expected), **gold_marts(expected)}
    for name, df in full.items():
        stored = result[name].select(*df.columns)
        assert stored.exceptAll(df).count() == 0 and df.exceptAll(stored).count() == 0, name
    assert {r["year"] for r in spark.read.json(os.path.join(out, "manifest")).collect()} == set(years[:3])
    assert {(r["year"], r["status"]) for r in result["run_log"].collect()} == {(y, "SUCCESS") for y in years[:3]}


RAW = "Prscrbr_NPI,Prscrbr_Last_Org_Name,Prscrbr_First_Name,Prscrbr_State_Abrvtn,Prscrbr_State_FIPS,Prscrbr_Type,Brnd_Name,Gnrc_Name,Tot_Clms,Tot_Drug_Cst,Tot_Benes"


def load(spark, rows, year):
    from helpers import raw_df

    return raw_df(spark, [dict(zip(RAW.split(","), r, strict=True)) for r in rows]).withColumn("year", F.lit(year)).withColumn("_corrupt_record", F.lit(None).cast("string"))


def people(year, first="Ann", fips="01", state="VT", cost=None):
    """Forty prescribers of one peer group; the last one far above the others."""
    price = lambda i: str(cost if cost and i == 39 else 100 + i)
    return [(f"{i}", "Lee", first, state, fips, "SLEEP", f"B{i % 3}", "G", "50", price(i), "5") for i in range(40)]


TABLES = ["silver", "rejects", "gold_state_year_spending", "gold_drug_year_spending", "gold_specialty_state_spending", "gold_prescriber_summary", "gold_anomaly_prescribers", "dim_prescriber", "dim_drug", "dim_state", "dim_year", "fact_prescriptions"]


def same_tables(a, b):
    for name in TABLES:
        x, y = a[name], b[name].select(*a[name].columns)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name


def test_a_corrected_reload_equals_a_rebuild(spark, tmp_dir):
    bad = [*people(2031, cost=90000)[:-2], ("38", "Lee", "Ann", " ", "01", "SLEEP", "B2", "G", "50", "138", "5"), people(2031, cost=90000)[-1], ("99", "Lee", "Ann", "VT", "01", "SLEEP", "B", "G", "50", "-4", "5")]
    good, other = people(2031, first="Zed", fips="09"), people(2032, first="Zed", fips="09")
    out = os.path.join(tmp_dir, "a")
    first = run_pipeline(spark, load(spark, bad, 2031), out, "r1", export_csv=False)
    assert first["rejects"].count() == 1 and first["gold_anomaly_prescribers"].count() == 1
    assert first["gold_state_year_spending"].where("state = 'UNKNOWN'").count() == 1
    run_pipeline(spark, load(spark, other, 2032), out, "r2", export_csv=False)
    got = run_pipeline(spark, load(spark, good, 2031), out, "r3", export_csv=False)
    both = load(spark, good, 2031).unionByName(load(spark, other, 2032))
    want = run_pipeline(spark, both, os.path.join(tmp_dir, "b"), "r1", export_csv=False)
    same_tables(got, want)
    one = {r["year"]: (r["row_count"], r["checksum_sha256"]) for r in spark.read.json(f"{out}/manifest").collect()}
    assert one == {r["year"]: (r["row_count"], r["checksum_sha256"]) for r in spark.read.json(f"{tmp_dir}/b/manifest").collect()}
    # The same content again is skipped.
    again = run_pipeline(spark, load(spark, good, 2031), out, "r4", export_csv=False)
    same_tables(again, want)
    assert again["run_log"].where("run_id = 'r4'").count() == 0


def test_a_count_mismatch_stops_a_full_load(spark, tmp_dir):
    from rxlake.plans.pipeline import IncompleteLoad

    counts = spark.createDataFrame([(2031, 41)], "year int, expected_row_count long")
    out = os.path.join(tmp_dir, "c")
    with pytest.raises(IncompleteLoad):
        run_pipeline(spark, load(spark, people(2031), 2031), out, "r1", expected_counts=counts, export_csv=False)
    assert [r["status"] for r in spark.read.parquet(f"{out}/run_log").collect()] == ["FAILED"]
    assert not os.path.exists(f"{out}/gold")
    done = run_pipeline(spark, load(spark, people(2031), 2031), out, "r2", expected_counts=counts, partial=True, export_csv=False)
    status = {r["check_name"]: r["status"] for r in done["quality"].collect()}
    assert status["row_count_2031"] == "WARN"
    assert {(r["run_id"], r["status"]) for r in done["run_log"].collect()} == {("r1", "FAILED"), ("r2", "SUCCESS")}


def test_going_back_to_earlier_content_loads_it_again(spark, tmp_dir):
    a, b = people(2031), people(2031, first="Zed", cost=90000)
    out = os.path.join(tmp_dir, "aba")
    found = []
    for n, rows in enumerate((a, b, a)):
        got = run_pipeline(spark, load(spark, rows, 2031), out, f"r{n}", export_csv=False)
        found.append({t: sorted(map(str, got[t].collect())) for t in TABLES})
    assert found[2] == found[0] != found[1]
    assert {(r["run_id"], r["status"]) for r in got["run_log"].collect()} == {(f"r{n}", "SUCCESS") for n in range(3)}


def test_a_run_that_dies_before_the_switch_leaves_the_former_tables(spark, tmp_dir, monkeypatch):
    from rxlake.plans import pipeline

    out = os.path.join(tmp_dir, "kill")
    first = run_pipeline(spark, load(spark, people(2031), 2031), out, "r1", export_csv=False)
    before = {n: sorted(map(str, first[n].collect())) for n in TABLES}

    class Killed(Exception):
        pass

    def dies(self):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(pipeline.Lake, "commit", dies)
        with pytest.raises(Killed):
            run_pipeline(spark, load(spark, people(2031, first="Zed", fips="09"), 2031), out, "r2", export_csv=False)
    after = pipeline.open_lake(spark, out)
    assert {n: sorted(map(str, after[n].collect())) for n in TABLES} == before
    assert {(r["run_id"], r["status"]) for r in pipeline.lineage.read_log(spark, f"{out}/run_log").collect()} == {("r1", "SUCCESS"), ("r2", "RUNNING")}
    # What the dead run wrote is left behind until it is cleared.
    lake = pipeline.Lake(spark, out)
    assert lake.vacuum() > 0 and lake.vacuum() == 0
    assert {n: sorted(map(str, df.collect())) for n, df in pipeline.open_lake(spark, out).items() if n in before} == before


def test_a_writer_that_loses_rows_fails_the_row_flow(spark, tmp_dir):
    from rxlake.operators import quality
    from rxlake.plans import pipeline

    bad = ("99", "Lee", "Ann", "VT", "01", "SLEEP", "B", "G", "50", "-4", "5")
    staged = pipeline.stage_bronze(load(spark, [*people(2031), *people(2031)[:5], bad], 2031), f"{tmp_dir}/bronze")
    flow, metrics = pipeline.write_silver(pipeline.Lake(spark, f"{tmp_dir}/good"), staged, [2031])
    assert flow == quality.RowFlow(46, 45, 40, 1, 40) and metrics["rows"] == 40 and metrics["npi_present"] == 0

    class Lossy(pipeline.Lake):
        def stage(self, name, df, years=None, **kw):
            super().stage(name, df, years, **kw)
            again = self.read(name, df.schema, years)
            if name == "silver":
                rows = again.where("npi <> '7'").collect()
                super().stage(name, spark.createDataFrame(rows, again.schema), years, inner=kw["inner"])
            else:
                super().stage(name, again.limit(0), years)

    flow, _ = pipeline.write_silver(Lossy(spark, f"{tmp_dir}/bad"), staged, [2031])
    assert {r["check_name"]: r["status"] for r in quality.row_flow_check(spark, flow, "r", "d").collect()} == {"bronze_minus_rejected_equals_accepted": "FAIL", "silver_written_equals_unique": "FAIL"}


def test_two_runs_cannot_both_switch(spark, tmp_dir):
    from rxlake.sources.versions import ConcurrentCommit, Lake

    rows = spark.createDataFrame([(2031, 1), (2032, 2)], "year int, v int")
    one, two = Lake(spark, tmp_dir), Lake(spark, tmp_dir)
    one.stage("t", rows, [2031, 2032, 2033])
    two.stage("t", rows.where("v = 2"), [2032])
    one.commit()
    with pytest.raises(ConcurrentCommit):
        two.commit()
    now = Lake(spark, tmp_dir)
    assert sorted(map(tuple, now.read("t", rows.schema).collect())) == [(2031, 1), (2032, 2)]
    assert now.read("t", rows.schema, [2033]).count() == 0 and now.read("none", rows.schema).count() == 0
