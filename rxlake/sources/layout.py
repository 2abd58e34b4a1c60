"""Layouts of partitioned Parquet tables: files of measured size, and bands of a
metric for reading its highest rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rxlake.session import PARQUET, discard, stored

#: Rows of a file at most.
ROWS_PER_FILE = 4_000_000
#: Rows of a task that writes several files.
ROWS_PER_TASK = 200_000
#: Runs (a folder's rows in one stored piece) that are known to every task at most.
MOST_RUNS = 1 << 17
BAND = "_band"


def write_sized(df: DataFrame, path: str, by: list[str], rows_per_file: int = ROWS_PER_FILE, dynamic: bool = True) -> DataFrame:
    """Write ``df`` partitioned by ``by``, each folder in ceil(rows / rows_per_file)
    files of at most that many rows, within a factor of two of each other: full ones
    and two that share the rest. Folders are measured first, so a hot one, of whatever
    share, becomes many files. A task writes one file of a folder, or as many short
    ones as hold ``ROWS_PER_TASK`` rows. Where ``dynamic``, folders that ``df`` has no
    rows for stay. Returns the sizes: ``by``, ``rows``, ``files``.

    Rows are stored with their numbers, sorted by folder, before they are written, so a
    task that is run again writes the same rows. Full files that lie within a stored
    piece are written from there; only what is left of the pieces is dealt out. Where
    there are more than ``MOST_RUNS`` runs, all rows are dealt."""
    spark = df.sparkSession
    taken = {c.lower() for c in df.columns} & {"_row", "_piece", "_read", "_n", "_from", "_direct", "_left", "_before", "_first", "_to", "rows", "files"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are used by the layout")
    # A task's rows of one folder are numbered without gaps.
    rows = stored(df.sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id()), "sized")
    # Shuffle files of what led here go when the driver's JVM collects what refers to them.
    spark.sparkContext._jvm.System.gc()
    # A piece is a stored file, by the numbers of its rows.
    piece = F.struct(F.shiftright("_row", 33).alias("task"), F.floor(F.col("_row").bitwiseAND((1 << 33) - 1) / PARQUET["maxRecordsPerFile"]).alias("file"))
    read = rows.select(*by, "_row", piece.alias("_piece"), F.spark_partition_id().alias("_read"))
    runs = stored(read.groupBy("_piece", *by).agg(F.count("*").alias("_n"), F.min("_row").alias("_from"), (F.min("_read") == F.max("_read")).alias("_read")), "runs")
    # Full files of a run, unless readers split its piece.
    known = rows_per_file <= PARQUET["maxRecordsPerFile"] and runs.count() <= MOST_RUNS
    runs = runs.withColumn("_direct", F.when(F.col("_read"), F.floor(F.col("_n") / rows_per_file) * rows_per_file).otherwise(0) if known else F.lit(0).cast("long"))
    # What is left of a folder is a file at least, or a full one is left with it.
    folder = Window.partitionBy(*by)
    left = F.sum(F.col("_n") - F.col("_direct")).over(folder)
    giver = F.row_number().over(folder.orderBy(F.when(F.col("_direct") > 0, 0).otherwise(1), "_piece")) == 1
    runs = runs.withColumns({"_left": left, "_to": giver})
    gives = F.col("_to") & (F.col("_left") > 0) & (F.col("_left") < rows_per_file) & (F.col("_direct") > 0)
    runs = stored(runs.withColumn("_direct", F.col("_direct") - F.when(gives, rows_per_file).otherwise(0)).drop("_left", "_to", "_read"), "runs")
    sizes = runs.groupBy(*by).agg(F.sum("_n").alias("rows"), F.sum("_direct").alias("_direct"))
    sizes = sizes.select(*by, "rows", F.ceil(F.col("rows") / rows_per_file).alias("files"), "_direct", (F.col("rows") - F.col("_direct")).alias("_left"))
    # The last file of a folder is one task; the others, all but one of them full, are dealt in runs.
    per_task = max(1, ROWS_PER_TASK // rows_per_file)
    dealt_files = F.ceil(F.col("_left") / rows_per_file)
    tasks = F.when(F.col("_left") == 0, 0).otherwise(F.greatest(F.ceil((dealt_files - 1) / per_task) + 1, F.lit(1)))
    # One row a folder; nothing else passes through this window.
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.withColumn("_first", F.coalesce(F.sum(tasks).over(before), F.lit(0))), "sizes")
    total, direct = sizes.agg(F.max(F.col("_first") + tasks), F.sum(F.ceil(F.col("_direct") / (rows_per_file * per_task)))).first()
    # One row a folder and piece of the stored rows.
    earlier = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("_before", F.coalesce(F.sum(F.col("_n") - F.col("_direct")).over(earlier), F.lit(0)))
    placed = placed.alias("r").join(sizes.alias("s"), _same(by, "r", "s")).select("r.*", "_left", "_first")
    nth = F.col("_before") + F.col("_row") - F.col("_from") - F.col("_direct")
    shared = F.col("_left") - (dealt_files - 2) * rows_per_file
    last = (dealt_files > 1) & (nth >= F.col("_left") - F.floor(shared / 2))
    task = F.col("_first") + F.when(last, tasks - 1).otherwise(F.floor(nth / (rows_per_file * per_task)))
    in_run = (F.col("r._piece") == F.col("s._piece")) & _same(by, "r", "s")
    told = rows.withColumn("_piece", piece).alias("r").join(F.broadcast(placed.alias("s")) if known else placed.alias("s"), in_run)
    in_place = F.col("_row") - F.col("_from") < F.col("_direct")
    columns = [F.col(f"r.`{c}`") for c in df.columns]
    dealt = told.where(~in_place).select(*columns, task.cast("int").alias("_to"))
    out = dealt.repartitionById(max(1, int(total or 0)), "_to").drop("_to")
    if direct:
        out = told.where(in_place).select(*columns).coalesce(int(direct)).unionByName(out)
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if dynamic:
        # Tasks move their files into the staging folder, whose folders are switched at the end.
        writer = writer.option("partitionOverwriteMode", "dynamic").option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    else:
        writer = writer.option("partitionOverwriteMode", "static")
    writer.partitionBy(*by).parquet(path)
    discard(rows)
    return sizes.select(*by, "rows", "files")


def _same(columns: list[str], left: str, right: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def write_banded(df: DataFrame, path: str, metric: str, bands: int = 64, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` in folders by bands of ``metric``, higher values in higher bands,
    NULL below all. A sketch of the metric places the cuts; equal values are in one
    band. The rows of each band are counted beside the table."""
    points = [i / bands for i in range(1, bands)]
    cuts = sorted(set(df.agg(F.percentile_approx(metric, points)).first()[0] or []))
    band = reduce(Column.__add__, [(F.col(metric) >= c).cast("int") for c in cuts], F.lit(0))
    band = F.when(F.col(metric).isNull(), -1).otherwise(band)
    sizes = write_sized(df.withColumn(BAND, band), path, [BAND], rows_per_file, dynamic=False)
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{path}/_sizes")


def read_top(spark: SparkSession, path: str, schema: StructType, metric: str, k: int, ties: list[str]) -> DataFrame:
    """The ``k`` highest rows of a banded table of ``schema`` (NULL last, ties by ``ties``,
    ascending, NULL last): only bands that can hold one are listed and opened."""
    sizes = {r[BAND]: r["rows"] for r in spark.read.parquet(f"{path}/_sizes").select(BAND, "rows").collect()}
    lowest, held = max(sizes, default=-1), 0
    for lowest in sorted(sizes, reverse=True):
        held += sizes[lowest]
        if held >= k:
            break
    table = spark.read.schema(StructType([*schema.fields, StructField(BAND, IntegerType())])).parquet(path)
    top = table.where(F.col(BAND) >= lowest).drop(BAND)
    return top.orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]).limit(k)
