"""Raw-shaped ("Bronze") rows derived from the TPC-H-like test tables.

The test tables carry no prescription data, so a raw view is derived from them
with deterministic dirt (suppression tokens, thousands commas, blanks, NULL
flags, malformed and over-long numbers, negative costs, blank ids and labels, two
spellings of a name, brand names equal to the generic name) that exercises every
cleaning and quality rule. Mapping: prescriber = customer,
city = nation, state = region, specialty = market segment, drug = part
(brand, type), claims = quantity, cost = extended price, year = order year.

The view is the landed Bronze of the test tables: ``standin_raw`` derives it once a
session, stores it as Parquet in the shared folder, and every query reads that, as
the job reads its staged rows. The same definition is written as SQL for the oracle
(see ``plans.oracle``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.schemas import RAW_COLUMNS
from rxlake.session import PARQUET, ensure_checkpoint_dir

#: Lines joined by one task at most, on average.
ROWS_PER_TASK = 1_000_000
TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]


def read_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def _text(c) -> F.Column:
    return c.cast("string")


def _state_of(spark: SparkSession, sf_dir: str) -> str:
    """A digest of the tables' files: names, lengths and times."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in TABLES:
        at = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        found += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in at.getFileSystem(conf).listStatus(at)]
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:32]


def standin_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored view: all 22 raw columns as strings plus ``yr`` (int). It is derived
    when a session first asks for these files, over at least as many tasks as there are
    shuffle partitions, so that its readers are spread however the tables are laid out."""
    path = f"{ensure_checkpoint_dir(spark)}/standin-{_state_of(spark, sf_dir)}"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        derive_raw(spark, sf_dir).write.mode("overwrite").options(**PARQUET).parquet(path)
        # The shuffle files of the joins go when the driver's JVM collects what refers to them.
        spark.sparkContext._jvm.System.gc()
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.read.schema(f"{schema}, yr int").parquet(path)


def derive_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a plan over the test tables, one row per lineitem."""
    t = read_tables(spark, sf_dir, TABLES)
    # No hints: the planner broadcasts nation and region by their file sizes.
    geo = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    line = t["lineitem"].select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    part = t["part"].select("p_partkey", "p_brand", "p_type")
    customer = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    people = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate").join(people, F.col("o_custkey") == F.col("c_custkey"))
    # Lines meet their part while they are narrow. Dealt out by the order's key, of few
    # lines each, before the rest: a test table may be one split.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-line.count() // ROWS_PER_TASK))
    line = line.join(part, F.col("l_partkey") == F.col("p_partkey")).repartition(tasks, "l_orderkey")
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    qty_int = F.col("l_quantity").cast("int")
    price_text = _text(F.col("l_extendedprice").cast("decimal(18,2)"))
    derived = {
        "Prscrbr_NPI": F.when(F.col("c_custkey") % 83 == 0, F.lit(None).cast("string"))
        .when(F.col("c_custkey") % 41 == 0, F.lit("  ")).otherwise(
            F.concat(F.lit(" "), _text(F.col("c_custkey")), F.lit(" "))
        ),
        "Prscrbr_Last_Org_Name": F.col("c_name"),
        "Prscrbr_First_Name": F.when(F.col("c_custkey") % 5 == 0, F.lit(""))
        .when(F.col("o_orderkey") % 50 == 0, F.lit("Patricia"))
        .otherwise(F.lit("Pat")),
        "Prscrbr_City": F.when(F.col("c_custkey") % 37 == 0, F.lit(" ")).otherwise(F.lower("n_name")),
        "Prscrbr_State_Abrvtn": F.when(F.col("c_custkey") % 97 == 0, F.lit("")).otherwise(F.lower("r_name")),
        "Prscrbr_State_FIPS": _text(F.col("r_regionkey")),
        "Prscrbr_Type": F.when(F.col("c_custkey") % 29 == 0, F.lit("")).otherwise(F.lower("c_mktsegment")),
        "Brnd_Name": F.when(F.col("p_partkey") % 17 == 0, F.concat(F.lit(" "), F.upper("p_type")))
        .when(F.col("p_partkey") % 59 == 0, F.lit(""))
        .otherwise(F.lower("p_brand")),
        "Gnrc_Name": F.when(F.col("p_partkey") % 53 == 0, F.lit(None).cast("string"))
        .when(F.col("p_partkey") % 3 == 0, F.lit("multisource"))
        .otherwise(F.lower("p_type")),
        "Tot_Clms": F.when(F.col("l_orderkey") % 227 == 0, F.lit("9" * 20))
        .when(F.col("l_orderkey") % 229 == 0, F.lit("20.0"))
        .when(F.col("l_quantity") < 3, F.lit("*"))
        .when(F.col("l_partkey") % 31 == 0, F.concat(F.lit("1,"), F.lpad(_text(qty_int), 3, "0")))
        .otherwise(_text(qty_int)),
        "Tot_Drug_Cst": F.when(F.col("l_orderkey") % 211 == 0, F.lit("-5.25"))
        .when(F.col("l_orderkey") % 223 == 0, F.lit("1e5"))
        .when(F.col("l_orderkey") % 97 == 0, _text((F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("decimal(20,2)")))
        .otherwise(price_text),
        "Tot_Benes": F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(_text(F.col("l_linenumber"))),
        "GE65_Sprsn_Flag": F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "A", F.lit(""))
        .when(F.col("l_linenumber") % 2 == 0, F.lit("y "))
        .otherwise(F.lit("#")),
        "GE65_Tot_Clms": F.when(F.col("l_linenumber") == 1, F.lit("*")).otherwise(
            _text(F.floor(F.col("l_quantity") / 2).cast("int"))
        ),
        "GE65_Tot_Drug_Cst": F.when(F.col("l_linenumber") == 2, F.lit("N/A")).otherwise(price_text),
        "Tot_30day_Fills": F.concat(_text(qty_int), F.lit(".5")),
        "Tot_Day_Suply": _text(qty_int * 30),
    }
    columns = [derived.get(c, F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS]
    return joined.select(*columns, F.year("o_orderdate").cast("int").alias("yr"))
