"""The folder all executors can reach, and how long tables stay there.

A table written with ``stored`` belongs to the innermost ``Scratch`` that is open; one that is closed
removes its tables. Without any, files are the cluster's to expire, as checkpoints are: whoever
returns a table that is computed when it is used can't know when its inputs are no longer needed.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_OPEN: ContextVar[Scratch | None] = ContextVar("open scratch", default=None)


class Scratch:
    """Owner of the tables that are stored while it is entered.

    Leaving the ``with`` block removes them. ``keep`` stores a result for whoever is outside, so that
    what it was computed from can go. ``detached`` scratches survive their block until ``close`` or
    ``release``, which hands the tables to the scratch around it."""

    def __init__(self, spark: SparkSession, detached: bool = False) -> None:
        self.spark, self.detached = spark, detached
        self.paths: list[str] = []
        self.outer: Scratch | None = None

    def __enter__(self) -> Scratch:
        self.outer = _OPEN.get()
        self._token = _OPEN.set(self)
        return self

    def __exit__(self, *failure) -> None:
        _OPEN.reset(self._token)
        if not self.detached or failure[0]:
            self.close()

    def close(self) -> None:
        """Remove the tables. Nothing that reads them may be computed any more."""
        while self.paths:
            remove(self.spark, self.paths.pop())

    def release(self) -> None:
        if self.outer is not None:
            self.outer.paths.extend(self.paths)
        self.paths = []

    def keep(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        path = fresh_path(self.spark, name)
        if self.outer is not None:
            self.outer.paths.append(path)
        return _written(df, path, codec)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables, as named in ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder is used in local mode only: on a cluster,
    files on the driver's disk would be out of the executors' reach.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabloom-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else writes to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, codec: str) -> DataFrame:
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back, for results that are dear to compute and
    read more than once. ``codec`` is the Parquet compression; ``zstd`` is for large tables."""
    path = fresh_path(df.sparkSession, name)
    if (scratch := _OPEN.get()) is not None:
        scratch.paths.append(path)
    return _written(df, path, codec)
