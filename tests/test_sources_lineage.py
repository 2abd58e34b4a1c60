"""Sources, sinks, lineage, upsert and the streaming landing (round trips in
fresh temporary folders)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from rxlake.operators import lineage, quality, upsert
from rxlake.schemas import CORRUPT_COLUMN, RAW_COLUMNS
from rxlake.sources import bronze, files
from rxlake.streaming import land_to_bronze


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_binds_columns_by_header_name(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    write(p, "Tot_Clms,Prscrbr_NPI,Extra\n20,123,x\n30,456,y\n")
    df = bronze.read_bronze_csv(spark, p, year=2022)
    rows = sorted((r["Prscrbr_NPI"], r["Tot_Clms"], r["Brnd_Name"]) for r in df.collect())
    assert rows == [("123", "20", None), ("456", "30", None)]
    assert df.columns[: len(RAW_COLUMNS)] == RAW_COLUMNS and "year" in df.columns


def test_short_csv_row_goes_to_corrupt_column(spark, tmp_dir):
    p = os.path.join(tmp_dir, "b.csv")
    write(p, "Prscrbr_NPI,Tot_Clms,Tot_Drug_Cst\n1,2,3\n4,5\n")
    df = bronze.read_bronze_csv(spark, p).cache()
    bad = df.where(F.col(CORRUPT_COLUMN).isNotNull()).select("Prscrbr_NPI").collect()
    assert [r[0] for r in bad] == ["4"]


def test_years_with_different_header_orders(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "y1.csv"), os.path.join(tmp_dir, "y2.csv")
    write(a, "Prscrbr_NPI,Tot_Clms\n1,10\n")
    write(b, "Tot_Clms,Prscrbr_NPI\n20,2\n")
    df = bronze.read_bronze_years(spark, {2021: a, 2022: b})
    assert sorted((r["year"], r["Prscrbr_NPI"], r["Tot_Clms"]) for r in df.collect()) == [(2021, "1", "10"), (2022, "2", "20")]


def test_landed_pages_and_page_limit(spark, tmp_dir):
    for i in range(3):
        write(os.path.join(tmp_dir, f"pages/page_{i}.json"), json.dumps([{"Prscrbr_NPI": str(i), "Tot_Clms": "5", "other": 1}]))
    path = os.path.join(tmp_dir, "pages")
    assert bronze.read_landed_pages(spark, path).count() == 3
    assert bronze.read_landed_pages(spark, path, max_pages=1).select("Prscrbr_NPI").collect()[0][0] == "0"


@pytest.mark.parametrize(
    ("document", "want"),
    [({k: 40 + i}, 40 + i) for i, k in enumerate(bronze.TOTAL_ROW_KEYS)]
    + [({k: str(70 + i)}, 70 + i) for i, k in enumerate(bronze.TOTAL_ROW_KEYS)]
    + [({"count": 5, "total_rows": "n/a"}, 5), ({"rowCount": 8, "count": 9}, 8), ({"rows": 3}, None), ({"count": "12x"}, None)],
)
def test_expected_count_keys(spark, tmp_dir, document, want):
    write(os.path.join(tmp_dir, "stats/s.json"), json.dumps(document))
    assert bronze.read_source_stats(spark, os.path.join(tmp_dir, "stats")).first()["expected_row_count"] == want


def test_files_of_one_folder_with_different_headers(spark, tmp_dir):
    write(os.path.join(tmp_dir, "f/a.csv"), "Prscrbr_NPI,Tot_Clms\n11,5\n")
    write(os.path.join(tmp_dir, "f/b.csv"), "Tot_Clms,Other,Prscrbr_NPI\n6,x,12\n")
    rows = bronze.read_bronze_csv(spark, os.path.join(tmp_dir, "f")).select("Prscrbr_NPI", "Tot_Clms").collect()
    assert sorted(map(tuple, rows)) == [("11", "5"), ("12", "6")]


def test_quotes_and_line_breaks_in_raw_text(spark, tmp_dir):
    p = os.path.join(tmp_dir, "q.csv")
    write(p, 'Prscrbr_NPI,Brnd_Name,Gnrc_Name\n1,"AB ""X"" C","one\ntwo"\n2,"a,b",\\n\n3,short\n')
    rows = {r["Prscrbr_NPI"]: r for r in bronze.read_bronze_csv(spark, p).collect()}
    assert (rows["1"]["Brnd_Name"], rows["1"]["Gnrc_Name"]) == ('AB "X" C', "one\ntwo")
    assert (rows["2"]["Brnd_Name"], rows["2"]["Gnrc_Name"]) == ("a,b", "\\n")
    assert {k: r[CORRUPT_COLUMN] is not None for k, r in rows.items()} == {"1": False, "2": False, "3": True}


def test_csv_round_trip_of_odd_text(spark, tmp_dir):
    rows = [("a", 'say "hi"'), ("b", "back\\slash"), ("c", "com,ma"), ("d", "line\nbreak"), ("e", '"'), ("f", "\\\"")]
    df = spark.createDataFrame(rows, "k string, v string")
    files.write_csv_tables({"t": df}, tmp_dir)
    assert sorted(map(tuple, files.read_csv_table(spark, os.path.join(tmp_dir, "t"), df.schema).collect())) == rows


def test_pages_by_number_gaps_and_broken_pages(spark, tmp_dir):
    for n, text in ((0, '[{"Prscrbr_NPI": "1"}]'), (1, '[{"Prscrbr_NPI": "2"}'), (2, "[]"), (3, '[{"Prscrbr_NPI": "4"}]')):
        write(os.path.join(tmp_dir, f"p/part_d_2031_page_{n}.json"), text)
    path = os.path.join(tmp_dir, "p")
    rows = bronze.read_landed_pages(spark, path).cache()
    assert {r["page_no"]: (r["Prscrbr_NPI"], r[CORRUPT_COLUMN] is not None) for r in rows.collect()} == {0: ("1", False), 1: (None, True)}
    assert bronze.read_landed_pages(spark, path, max_pages=1).count() == 1


def test_overwrite_and_null_keys(spark, tmp_dir):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    files.overwrite_table(a, f"{tmp_dir}/t")
    files.overwrite_table(a.limit(1), f"{tmp_dir}/t")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 1
    out = upsert.upsert_by_key(a, spark.createDataFrame([(None, "c")], "k int, v string"), ["k"])
    assert sorted((r["v"] for r in out.collect())) == ["a", "c"]


def test_second_year_keeps_the_first(spark, tmp_dir):
    out = os.path.join(tmp_dir, "silver")
    y1 = spark.createDataFrame([(2021, "CA", 1)], "year int, state string, v int")
    y2 = spark.createDataFrame([(2022, "CA", 2)], "year int, state string, v int")
    files.write_partitioned_parquet(y1, out)
    files.write_partitioned_parquet(y2, out)
    assert sorted(r["year"] for r in spark.read.parquet(out).collect()) == [2021, 2022]
    files.write_partitioned_parquet(y2.withColumn("v", F.lit(3)), out)
    assert sorted((r["year"], r["v"]) for r in spark.read.parquet(out).collect()) == [(2021, 1), (2022, 3)]


def test_csv_export_blank_and_null_read_back_as_null(spark, tmp_dir):
    df = spark.createDataFrame([("a", ""), ("b", None)], "k string, v string")
    files.write_csv_tables({"t": df}, tmp_dir, files_per_table=1)
    back = files.read_csv_table(spark, os.path.join(tmp_dir, "t"), df.schema)
    assert sorted((r["k"], r["v"]) for r in back.collect()) == [("a", None), ("b", None)]


def test_fingerprint_ignores_order_but_sees_edits(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 3 % 7).cast("string").alias("s"))
    fp = lambda d: lineage.table_fingerprint(d, ["id", "s"]).collect()[0]
    base = fp(df)
    assert fp(df.repartition(7).orderBy(F.rand(1))) == base
    assert fp(df.withColumn("s", F.when(F.col("id") == 5, "x").otherwise(F.col("s"))))["checksum_sha256"] != base["checksum_sha256"]
    assert fp(df.where("id != 3"))["row_count"] == 999


def manifest(spark):
    raw = spark.createDataFrame([(2021, "a"), (2021, "b"), (2022, "c")], "yr int, Prscrbr_NPI string")
    expected = spark.createDataFrame([(2021, 2), (2022, 5)], "year int, expected_row_count long")
    return lineage.build_manifest(raw, "ds", "id1", "src", 5000, "2024-01-01T00:00:00+00:00", year_col="yr", expected=expected)


def test_manifest_and_count_check(spark):
    m = manifest(spark)
    st = {r["year"]: r["count_status"] for r in lineage.row_count_status(m).collect()}
    assert st == {2021: "PASS", 2022: "FAIL"}
    st = {r["year"]: r["count_status"] for r in lineage.row_count_status(m, partial=True).collect()}
    assert st == {2021: "PASS", 2022: "WARN"}


def test_run_log_upsert_and_skip_rule(spark):
    m = manifest(spark)
    running = lineage.log_records(m, "r1", "RUNNING", "2024-01-01 00:00:00", None, "f/{year}", "m/{year}")
    done = lineage.log_records(m.where("year = 2021"), "r1", "SUCCESS", "2024-01-01 00:00:00", "2024-01-01 00:10:00", "f/{year}", "m/{year}")
    log = lineage.upsert_run_log(running, done)
    assert sorted((r["year"], r["status"], r["file_path"]) for r in log.collect()) == [(2021, "SUCCESS", "f/2021"), (2022, "RUNNING", "f/2022")]
    assert [r["year"] for r in lineage.skip_ingested(m, log).collect()] == [2022]
    check = quality.status_domain_check(log, ("RUNNING", "SUCCESS", "FAILED"), "r", "d", "bronze", "status_domain").collect()[0]
    assert check["status"] == "PASS"


def test_upsert_refuses_repeated_incoming_key(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    inc = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.upsert_by_key(t, inc, ["k"])
    ok = upsert.upsert_by_key(t, spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"])
    assert sorted(tuple(r) for r in ok.collect()) == [(1, "b"), (2, "c")]


def test_streaming_landing_picks_up_only_new_pages(spark, tmp_dir):
    land, out, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "bronze", "ckpt"))
    write(os.path.join(land, "year=2022/page_0.json"), json.dumps([{"Prscrbr_NPI": "1"}, {"Prscrbr_NPI": "2"}]))
    land_to_bronze(spark, land, out, ckpt)
    assert spark.read.parquet(out).count() == 2
    write(os.path.join(land, "year=2022/page_1.json"), json.dumps([{"Prscrbr_NPI": "3"}]))
    land_to_bronze(spark, land, out, ckpt)
    rows = spark.read.parquet(out).collect()
    assert sorted(r["Prscrbr_NPI"] for r in rows) == ["1", "2", "3"] and {r["year"] for r in rows} == {2022}


def test_checksum_check(spark):
    m = manifest(spark)
    same = {r["check_name"]: r["status"] for r in lineage.checksum_check(m, m, "r").collect()}
    assert set(same.values()) == {"PASS"}
    changed = lineage.build_manifest(
        spark.createDataFrame([(2021, "a"), (2021, "B"), (2022, "c")], "yr int, Prscrbr_NPI string"),
        "ds", "id1", "src", 5000, "t", year_col="yr",
    )
    st = {r["check_name"]: r["status"] for r in lineage.checksum_check(changed, m.where("year = 2021"), "r").collect()}
    assert st == {"checksum_unchanged_2021": "FAIL", "checksum_unchanged_2022": "WARN"}


def test_load_tables_upserts_in_contract_order(spark, tmp_dir):
    from helpers import silver_df, silver_row

    from rxlake.plans.pipeline import gold_marts

    s1 = silver_df(spark, [silver_row("1", "A", "CA", "X", "B", "G", 10, 100.0), silver_row("2", "B", "NY", "X", "B", "G", 5, 10.0)])
    counts = upsert.load_tables(spark, gold_marts(s1), tmp_dir, "marts")
    assert {r["table_name"]: r["row_count"] for r in counts.collect()}["gold_state_year_spending"] == 2
    # A corrected CA row and a new TX row: CA replaced, NY kept, TX added.
    s2 = silver_df(spark, [silver_row("1", "A", "CA", "X", "B", "G", 20, 100.0), silver_row("3", "C", "TX", "X", "B", "G", 1, 1.0)])
    upsert.load_tables(spark, gold_marts(s2), tmp_dir, "marts")
    got = {r["state"]: r["total_claims"] for r in spark.read.parquet(f"{tmp_dir}/gold_state_year_spending").collect()}
    assert got == {"CA": 20, "NY": 5, "TX": 1}
    with pytest.raises(ValueError):
        upsert.load_tables(spark, gold_marts(s2), tmp_dir, "other")


ODD_CSV = (
    'Prscrbr_NPI,Brnd_Name,Gnrc_Name\r\n'
    '1,"a, ""b""\r\nc",plain\r\n'
    '2,5" pipe,"two\n\n\nlines"\r\n'
    '\r\n'
    '3,"",""""\r\n'
    '4,"x\n'
    + "\n".join(f'line {i}, ""q"" and "" "' .replace('"', '""') for i in range(40))
    + '",z\r\n'
    '5,short\r\n'
    '6,"' + "y" * 500 + '",é\n'
    '7,a,"last"'
)


@pytest.mark.parametrize("split", ["16", "200"])
def test_records_are_whole_however_files_are_split(spark, tmp_dir, split):
    import csv
    import io

    from rxlake.sources import csv_scan

    for name, text in (("a.csv", ODD_CSV), ("b.csv", "Gnrc_Name,Prscrbr_NPI\n" + "".join(f'"g\n{i}",{i}\n' for i in range(100, 160))), ("c.csv", ""), ("d.csv", "Prscrbr_NPI\n")):
        write(os.path.join(tmp_dir, f"odd/{name}"), text)
    path = os.path.join(tmp_dir, "odd")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        if split == "16":
            assert csv_scan.physical_lines(spark, path).rdd.getNumPartitions() > 20
        rows = {r["Prscrbr_NPI"]: (r["Brnd_Name"], r["Gnrc_Name"], r[CORRUPT_COLUMN] is not None) for r in bronze.read_bronze_csv(spark, path).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = {}
    for r in list(csv.reader(io.StringIO(ODD_CSV, newline="")))[1:]:
        if r and r[0] not in ("2", "5"):
            want[r[0]] = (r[1] or None, r[2] or None, False)
    want["2"] = ('5" pipe', "two\n\n\nlines", False)
    want |= {str(i): (None, f"g\n{i}", False) for i in range(100, 160)}
    assert rows.pop("5")[2]
    assert rows == want


def test_the_state_of_a_line_follows_from_fields():
    from rxlake.sources.csv_scan import open_after

    for line, outside, inside in (("a,b", False, True), ('"a', True, False), ('"a""', True, False), ('a","b', True, True), ('5" x', False, False), ('"a",', False, False), (',"', True, False), ('""', False, True), ('x"",y', False, True)):
        assert (open_after(line, False), open_after(line, True)) == (outside, inside), line


def test_states_of_a_batch_are_those_of_its_lines():
    import random

    import pyarrow as pa

    from rxlake.sources import csv_scan

    draw = random.Random(7)
    lines = ["".join(draw.choice('"",ab é') for _ in range(draw.randrange(9))) for _ in range(6000)]
    ends = csv_scan.open_ends(pa.array(lines))
    for inside in (False, True):
        assert ends[inside].tolist() == [csv_scan.open_after(x, inside) for x in lines]
        begins, state = [], inside
        for i, x in enumerate(lines):
            if not state:
                begins.append(i)
            state = csv_scan.open_after(x, state)
        found, after = csv_scan._Lines(pa.array(lines)).walk(inside)
        assert found.tolist() == begins and after == state


def test_lines_are_cut_into_records_once(spark, tmp_dir):
    write(os.path.join(tmp_dir, "once/a.csv"), 'Prscrbr_NPI,Brnd_Name\n1,"a\nb"\n2,c\n')
    back = bronze.read_bronze_csv(spark, os.path.join(tmp_dir, "once"))
    assert back._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r["Prscrbr_NPI"], r["Brnd_Name"]) for r in back.collect()) == [("1", "a\nb"), ("2", "c")]
