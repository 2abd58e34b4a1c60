"""Tables kept in the shared folder, shipped code, and distributed prefix sums."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset, a temporary
    folder is chosen once for the session in local mode (tests, one machine); on a
    cluster executors would not share one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    found = found or spark.conf.get("spark.rxlake.scratch", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="rxlake-shared-")
        spark.conf.set("spark.rxlake.scratch", found)
    return found


def keep(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is
    cut, and a lost executor costs at most the tasks that read it."""
    spark = df.sparkSession
    path = f"{_kept_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    # Shuffle files of finished jobs go when the driver's JVM collects what
    # refers to them; long chains of jobs should not wait for that to happen.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def _kept_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/kept-{spark.sparkContext.applicationId}"


def discard(*tables: DataFrame) -> None:
    """Delete kept tables that nothing reads any more, nor what is to be computed yet."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f"/{os.path.basename(_kept_folder(df.sparkSession))}/" not in folder:
                raise ValueError(f"{folder} is no kept table")
            at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            at.getFileSystem(conf).delete(at, True)


def drop_kept(spark: SparkSession) -> None:
    """Delete all tables that this application has kept, once its results are
    written: results are lazy and read them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_kept_folder(spark))
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, whatever their own path holds."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="rxlake-code-"), "rxlake_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def free_name(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not use yet, one for each base."""
    used = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name, i = base, 0
        while name.lower() in used:
            i += 1
            name = f"{base}_{i}"
        used.add(name.lower())
        out.append(name)
    return out


def schema_of(df: DataFrame, ddl: str = "") -> StructType:
    """The schema of ``df`` followed by the columns of ``ddl``, all nullable."""
    fields = [*df.schema.fields, *(StructType.fromDDL(ddl).fields if ddl else [])]
    return StructType([type(f)(f.name, f.dataType, True) for f in fields])


def prefix_of_totals(totals: DataFrame, key: str, values: list[str], fanout: int = 1024) -> DataFrame:
    """Exclusive prefix sums ``before_<value>`` over integer ``key`` (one row
    each). Two levels: keys are summed by blocks of ``fanout``, so that one task
    orders at most the blocks, and each block is ordered in a task of its own."""
    blocks = totals.withColumn("_block", F.floor(F.col(key) / fanout))
    upper = blocks.groupBy("_block").agg(*[F.sum(v).alias(f"_b_{v}") for v in values])
    over_blocks = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select("_block", *[F.coalesce(F.sum(f"_b_{v}").over(over_blocks), F.lit(0)).alias(f"_u_{v}") for v in values])
    inside = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_i_{v}") for v in values])
    return blocks.join(upper, "_block").select(key, *[(F.col(f"_i_{v}") + F.col(f"_u_{v}")).alias(f"before_{v}") for v in values])


def global_prefix(df: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """``df`` with, for each value, the sum over all rows that precede in
    ``order`` (a total order). Range partitions, their totals, prefix sums of
    the totals, and running sums inside a partition: no task holds all rows."""
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    pid, *names = free_name(df, "_pid", *[f"_v_{v}" for v in values])
    rows = df.select("*", *[c.alias(n) for n, c in zip(names, values.values(), strict=True)])
    rows = keep(rows.repartitionByRange(parts, *order).withColumn(pid, F.spark_partition_id()), "ranges")
    totals = rows.groupBy(pid).agg(*[F.sum(n).alias(n) for n in names])
    starts = prefix_of_totals(totals, pid, names)
    inside = Window.partitionBy(pid).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for n in names:
        rows = rows.withColumn(f"_in{n}", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    out = rows.join(starts, pid)
    return out.select(*df.columns, *[(F.col(f"_in{n}") + F.col(f"before_{n}")).alias(v) for n, v in zip(names, values, strict=True)])
