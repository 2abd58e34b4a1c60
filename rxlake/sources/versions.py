"""Table versions behind one pointer.

A run writes new versions beside the old ones: ``<table>/version=<token>``, by
year where the table is yearly, each with one job. Readers follow the pointer, a
small file that names for every table the version that holds each year; replacing
it is the one switch that makes all tables of a run visible together. A run that
ends before the switch leaves readers what they had; ``vacuum`` removes versions
that no pointer names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Name of an unpartitioned table's one part.
WHOLE = ""


class ConcurrentCommit(RuntimeError):
    """Another run has moved the pointer since this one began."""


class Lake:
    """Versioned Parquet tables under ``root``, as of the pointer when opened;
    versions staged by this object are visible to its own reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.token = uuid.uuid4().hex[:12]
        pointer = self._load()
        self.commits: int = pointer["commit"]
        self.parts: dict[str, dict[str, str]] = pointer["tables"]

    # --- files ---------------------------------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self._conf)

    def _load(self) -> dict:
        at = self._path("_current.json")
        if not self._fs().exists(at):
            return {"commit": 0, "tables": {}}
        stream = self._fs().open(at)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _folders(self, path: str) -> list[str]:
        at = self._path(path)
        return [s.getPath().getName() for s in self._fs().listStatus(at) if s.isDirectory()] if self._fs().exists(at) else []

    # --- versions ------------------------------------------------------------------

    def stage(
        self, name: str, df: DataFrame, years: list[int] | None = None, year_col: str = "year", inner: tuple[str, ...] = (), observe: tuple[Observation, list] | None = None
    ) -> None:
        """Write a new version of a table: whole, or exactly its ``years`` (a year
        without rows becomes empty). ``observe`` counts the rows that are written, in
        the job and stage that write them."""
        path = f"{name}/version={self.token}"
        if years is not None:
            df = df.where(F.col(year_col).isin(years))
        if inner:
            df = df.hint("rebalance", year_col, *inner)
        if observe:
            df = df.observe(observe[0], *observe[1])
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if years is None:
            writer.parquet(f"{self.root}/{path}")
            self.parts[name] = {WHOLE: self.token}
            return
        writer.partitionBy(year_col, *inner).parquet(f"{self.root}/{path}")
        made = {f.partition("=")[2] for f in self._folders(path)}
        held = {y: v for y, v in self.parts.get(name, {}).items() if y not in {str(y) for y in years}}
        self.parts[name] = held | {str(y): self.token for y in years if str(y) in made}

    def read(self, name: str, schema: StructType, years: list[int] | None = None, year_col: str = "year") -> DataFrame:
        """The table as the pointer and this run's staged versions have it, of all
        years or some; only their folders are listed."""
        held = self.parts.get(name, {})
        if WHOLE in held:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/version={held[WHOLE]}")
        wanted = held if years is None else {y: v for y, v in held.items() if int(y) in years}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{name}/version={v}/{year_col}={y}" for y, v in sorted(wanted.items())]
        return self.spark.read.option("basePath", f"{self.root}/{name}").schema(schema).parquet(*paths).select(*schema.fieldNames())

    def commit(self) -> None:
        """Make all staged versions visible at once."""
        if self._load()["commit"] != self.commits:
            raise ConcurrentCommit(f"{self.root} has moved on from commit {self.commits}")
        fresh = self._path(f"_current.{self.token}.json")
        stream = self._fs().create(fresh, True)
        try:
            stream.write(bytearray(json.dumps({"commit": self.commits + 1, "tables": self.parts}, indent=1).encode()))
        finally:
            stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        over = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
        over[0] = getattr(fs, "Options$Rename").OVERWRITE
        fs.FileContext.getFileContext(self._fs().getUri(), self._conf).rename(fs.Path(f"{self._fs().makeQualified(fresh)}"), fs.Path(f"{self._fs().makeQualified(self._path('_current.json'))}"), over)
        self.commits += 1

    def vacuum(self) -> int:
        """Delete versions that the pointer does not name; how many."""
        gone, tables = 0, self._load()["tables"]
        for name in tables:
            for folder in self._folders(name):
                if folder.startswith("version=") and folder.partition("=")[2] not in tables[name].values():
                    gone += bool(self._fs().delete(self._path(f"{name}/{folder}"), True))
        return gone
