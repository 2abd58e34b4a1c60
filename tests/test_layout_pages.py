"""Page source, files of measured size, bands of a metric."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from rxlake.schemas import CORRUPT_COLUMN
from rxlake.session import PARQUET
from rxlake.sources import layout, pages


def land(folder, texts):
    os.makedirs(folder, exist_ok=True)
    for number, text in texts.items():
        with open(os.path.join(folder, f"page_{number}.json"), "w") as f:
            f.write(text)
    return folder


def records(*npis):
    return json.dumps([{"Prscrbr_NPI": n, "Tot_Clms": 5, "other": [1]} for n in npis])


def npis(df):
    return sorted(r[0] for r in df.select("Prscrbr_NPI").collect())


def test_pages_end_at_the_first_gap(spark, tmp_dir):
    at = land(f"{tmp_dir}/gap", {0: records("a", "b"), 1: records("c"), 3: "not read, so not parsed"})
    df = pages.read_pages(spark, at)
    assert npis(df) == ["a", "b", "c"]
    assert df.where(F.col(CORRUPT_COLUMN).isNotNull()).count() == 0
    assert {(r["page_no"], r["Tot_Clms"], r["Brnd_Name"]) for r in df.collect()} == {(0, "5", None), (1, "5", None)}


@pytest.mark.parametrize("empty", ["", "[]", " [ \n ] "])
def test_pages_end_at_an_empty_one(spark, tmp_dir, empty):
    at = land(f"{tmp_dir}/empty", {0: records("a"), 1: empty, 2: records("z")})
    assert npis(pages.read_pages(spark, at)) == ["a"]


def test_page_limit_and_ranges(spark, tmp_dir):
    at = land(f"{tmp_dir}/many", {i: records(f"{i:02}") for i in range(12)})
    assert npis(pages.read_pages(spark, at, max_pages=3)) == ["00", "01", "02"]
    assert npis(pages.read_pages(spark, at, max_pages=0)) == []
    all_pages = pages.read_pages(spark, at, pagesPerTask="5")
    assert all_pages.select(F.spark_partition_id()).distinct().count() == 3
    assert len(npis(all_pages)) == 12


def test_bad_page_keeps_its_text(spark, tmp_dir):
    at = land(f"{tmp_dir}/bad", {0: '[{"Prscrbr_NPI": "a"', 1: "[1, 2]", 2: '{"Prscrbr_NPI": 1.50}', 3: '[{"Prscrbr_NPI": true, "Tot_Clms": null}]'})
    got = {r["page_no"]: (r["Prscrbr_NPI"], r["Tot_Clms"], r[CORRUPT_COLUMN]) for r in pages.read_pages(spark, at).collect()}
    assert got == {0: (None, None, '[{"Prscrbr_NPI": "a"'), 1: (None, None, "[1, 2]"), 2: ("1.50", None, None), 3: ("true", None, None)}


def test_no_pages(spark, tmp_dir):
    assert pages.read_pages(spark, land(f"{tmp_dir}/none", {})).count() == 0


def test_hot_folder_becomes_files_of_one_size(spark, tmp_dir):
    # One state holds 60 % of the rows, all of them equal.
    df = spark.range(10_000, numPartitions=7).select(
        F.when(F.col("id") % 10 < 6, "HOT").when(F.col("id") % 10 < 9, "B").when(F.col("id") < 500, None).otherwise("C").alias("state"),
        F.when(F.col("id") % 10 < 6, 1).otherwise(F.col("id")).alias("v"),
    )
    path = f"{tmp_dir}/sized"
    sizes = {r["state"]: (r["rows"], r["files"]) for r in layout.write_sized(df, path, ["state"], 700).collect()}
    assert sizes == {"HOT": (6000, 9), "B": (3000, 5), "C": (950, 2), None: (50, 1)}
    back = spark.read.schema("v long, state string").parquet(path)
    assert sorted(map(str, back.select("state", "v").collect())) == sorted(map(str, df.collect()))
    files = back.groupBy("state", F.col("_metadata.file_path").alias("f")).count().collect()
    for state, (_, n) in sizes.items():
        own = [r["count"] for r in files if r["state"] == state]
        assert len(own) == n and max(own) <= 2 * min(own) and max(own) <= 720
    # Another load replaces its own folders only.
    layout.write_sized(df.where("state = 'C'").limit(3), path, ["state"], 700)
    assert {r[0]: r[1] for r in spark.read.schema("v long, state string").parquet(path).groupBy("state").count().collect()} == {"HOT": 6000, "B": 3000, "C": 3, None: 50}


def test_sized_empty_table_and_taken_names(spark, tmp_dir):
    assert layout.write_sized(spark.range(0).withColumn("s", F.lit("x")), f"{tmp_dir}/none", ["s"]).count() == 0
    with pytest.raises(ValueError, match="files"):
        layout.write_sized(spark.range(1).withColumn("Files", F.lit(1)), f"{tmp_dir}/x", ["id"])


COSTS = StructType([StructField("id", LongType()), StructField("cost", DoubleType())])


def banded(spark, tmp_dir, values, **kw):
    path = f"{tmp_dir}/banded"
    df = spark.createDataFrame(list(enumerate(values)), COSTS)
    layout.write_banded(df, path, "cost", **kw)
    want = [r["id"] for r in df.orderBy(F.col("cost").desc_nulls_last(), "id").collect()]
    return path, want


@pytest.mark.parametrize("values", [
    [float(i * 37 % 1009) for i in range(1009)],
    [5.0] * 300 + [1.0, 9.0, None, float("nan"), float("inf"), -1.0],
    [None] * 10,
    [None] * 40 + [2.0, 1.0],
    [],
], ids=["spread", "ties", "nulls", "few", "empty"])
def test_top_rows_by_band(spark, tmp_dir, values):
    path, want = banded(spark, tmp_dir, values, bands=16)
    for k in (1, 7, 25, 400):
        assert [r["id"] for r in layout.read_top(spark, path, COSTS, "cost", k, ["id"]).collect()] == want[:k]


def test_top_rows_open_few_files(spark, tmp_dir):
    path, want = banded(spark, tmp_dir, [float(i) for i in range(6400)], bands=64, rows_per_file=50)
    top = layout.read_top(spark, path, COSTS, "cost", 25, ["id"])
    held = spark.read.parquet(path)
    # Two files of 128 hold the band of the 25 highest.
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert f"isnotnull({layout.BAND}" in plan and "PartitionFilters: [" in plan
    assert len(held.inputFiles()) >= 128
    opened = spark.read.parquet(path).where(F.col(layout.BAND) >= 63).select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert opened <= 3
    assert [r["id"] for r in top.collect()] == want[:25]


def test_short_files_of_a_folder_share_a_task(spark, tmp_dir):
    # One task a file would be 121 tasks; a folder of 120 files is two.
    df = spark.range(60_100, numPartitions=5).select("id", F.when(F.col("id") < 100, "few").otherwise("many").alias("s"))
    layout.write_sized(df, f"{tmp_dir}/short", ["s"], 500)
    files = spark.read.schema("id long, s string").parquet(f"{tmp_dir}/short").groupBy("s", F.col("_metadata.file_name").alias("f")).count().collect()
    assert sorted(r["count"] for r in files if r["s"] == "many") == [500] * 120
    assert [r["count"] for r in files if r["s"] == "few"] == [100]
    assert len({r["f"].split("-")[1] for r in files}) == 3


def test_written_pages_hold_each_row_once(spark, tmp_dir):
    df = spark.range(1, 24, numPartitions=2).select(F.col("id").cast("string").alias("Prscrbr_NPI"), F.lit('a\n"').alias("Prscrbr_City"), (F.col("id") % 2).alias("f"), F.floor(F.col("id") / 2 - 0.5).alias("n"))
    pages.write_pages(df, f"{tmp_dir}/pages", "f", "n", 5)
    back = pages.read_pages(spark, f"{tmp_dir}/pages", pattern=r"page=(\d+)/[^/]*$")
    assert back.where(F.col(CORRUPT_COLUMN).isNotNull() | (F.col("Prscrbr_City") != 'a\n"')).count() == 0
    assert sorted(map(int, npis(back))) == list(range(1, 24))
    assert sorted(r["count"] for r in back.groupBy("page_no").count().collect()) == [1, 2, 5, 5, 5, 5]
    assert len([d for d in os.listdir(f"{tmp_dir}/pages") if d.startswith("page=")]) == 7
    # No page is gathered into one row.
    assert not [d for d in spark.read.text(f"{tmp_dir}/pages/page=0").collect() if d[0].count("Prscrbr_NPI") != 1]


@pytest.mark.parametrize("case", ["whole", "torn", "runs", "odd"])
def test_full_files_are_written_where_rows_lie(spark, tmp_dir, monkeypatch, case):
    monkeypatch.setitem(PARQUET, "maxRecordsPerFile", 4_000)
    settings = {}
    if case == "torn":
        # Readers split the stored files by their row groups.
        monkeypatch.setitem(PARQUET, "parquet.block.size", 4096)
        settings = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    if case == "runs":
        monkeypatch.setattr(layout, "MOST_RUNS", 3)
    df = spark.range(40_000, numPartitions=3)
    # 'b' has some rows more than its full files hold, 'one' a single one.
    df = df.select("id", F.when(F.col("id") == 7, "one").when(F.col("id") < 25_000, "a").when(F.col("id") < 30_001, "b").otherwise(None).alias("s"))
    if case == "odd":
        df = df.where("id < 25000 OR id % 10 = 1 OR id = 30000").coalesce(1)
    moved, kind = [], type(df)
    deal = kind.repartitionById
    monkeypatch.setattr(kind, "repartitionById", lambda self, *a: (moved.append(self.count()), deal(self, *a))[1])
    held = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = {r["s"]: (r["rows"], r["files"]) for r in layout.write_sized(df, f"{tmp_dir}/t", ["s"], 500).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    back = spark.read.schema("id long, s string").parquet(f"{tmp_dir}/t")
    want = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert sizes == {s: (n, -(-n // 500)) for s, n in want.items()}
    assert back.exceptAll(df).isEmpty() and back.count() == df.count()
    files = back.groupBy("s", F.col("_metadata.file_path").alias("f")).count().collect()
    for s, (n, count) in sizes.items():
        own = sorted(r["count"] for r in files if r["s"] == s)
        assert len(own) == count and own[-1] <= 500 and own[-1] <= 2 * own[0] and own.count(500) >= count - 2
    # What is left of some 14 runs, and a full file of each folder; else rows of split runs, or all.
    assert {"torn": 30_000, "runs": 40_000}.get(case, 0) <= sum(moved) <= {"torn": 40_000, "runs": 40_000}.get(case, 8_000)
