"""Intermediate tables in the folder that the whole cluster shares.

Operators cut their lineage by writing a table and reading it back.
The folder is the session's ``spark.checkpoint.dir``.  Where that is unset, a
local session (``local[n]``, as in tests) takes a temporary folder of this
machine; on a cluster that is an error, since executors could not read it.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Arrow batches handed to Python hold at most this many bytes.
BATCH_BYTES = "8m"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session, or one of our own where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="textlode-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds: long texts go to Python a few megabytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


class Scratch:
    """A folder of intermediate tables, removed when the driver ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)
        small_batches(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; shuffle files of the write are given up at its end."""
        conf = self.spark.conf
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        finally:
            conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keep_observed(self, df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
        """``keep``, and aggregates of the rows taken while they are written: no second job."""
        seen = Observation()
        return self.keep(df.observe(seen, *[m.alias(k) for k, m in measures.items()]), name), seen.get

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(self.path(name))

    def _remove(self, path: str) -> None:
        with contextlib.suppress(Exception):
            jvm = self.spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
