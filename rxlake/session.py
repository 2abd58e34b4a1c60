"""Session helpers: building a session and cutting lineage in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()

#: How tables between steps are written. A reading task takes 128 MB, with 4 MB for each
#: file; short files keep the rows of one task, which a sort holds, to about two million
#: however well they compress.
PARQUET = {"compression": "zstd", "maxRecordsPerFile": 100_000}

# Defaults for a new session; what is set at submit or by the caller wins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "rxlake", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Create a session, or return the active one with only ``conf`` applied.
    The master is never hard-coded for clusters: pass it only for local runs."""
    running = SparkSession.getActiveSession()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()
    defaults = {} if running else {k: v for k, v in DEFAULT_CONF.items() if not submitted.contains(k)}
    for key, value in {**defaults, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, shared by driver and
    executors. Where it is unset, a fresh temporary folder takes its place in local
    mode (tests, one machine); on a cluster executors would not share one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="rxlake-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to reliable storage so later stages (and lost executors)
    do not recompute its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_code(spark: SparkSession) -> None:
    """Give executors this package as a zip, whatever their own path holds, for the
    few operators that run Python in tasks."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="rxlake-package-")) / "rxlake_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage is cut,
    readers prune columns, and the planner knows the size. See ``drop_stored``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored/{name}-{uuid.uuid4().hex}"
    df.write.options(**PARQUET).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a ``stored`` table that nothing reads any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/stored/" not in folder:
            raise ValueError(f"{folder} is no stored table")
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        at.getFileSystem(conf).delete(at, True)


def drop_stored(spark: SparkSession) -> None:
    """Delete all that this session has ``stored``, once results are written: those
    not yet computed may read it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/stored")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
