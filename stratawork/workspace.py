"""Shared scratch storage for results that several jobs must read alike."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from .operators.joins import measured_bytes


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode (one machine, unit tests) a folder is made where neither the setting nor a
    checkpoint directory exists. On a cluster that is an error, as machines do not see each
    other's folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not current and not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not current:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratawork-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/stratawork/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`new_folder` with all that is in it."""
    if not path.startswith(f"{shared_root(spark)}/stratawork/"):
        raise ValueError(f"not a scratch folder: {path}")
    Storage(spark).delete(path)


class Storage:
    """The few file operations Spark has no call for, on any file system it can reach."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def names(self, folder: str) -> list[str]:
        """Names directly below ``folder``; none if it does not exist."""
        files, where = self._at(folder)
        return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []

    def exists(self, path: str) -> bool:
        files, where = self._at(path)
        return files.exists(where)

    def delete(self, path: str) -> None:
        files, where = self._at(path)
        files.delete(where, True)

    def move(self, old: str, new: str, replace: bool = False) -> None:
        """Rename; an existing file at ``new`` is an error unless it is to be replaced."""
        files, where = self._at(new)
        if replace and files.exists(where):
            files.delete(where, False)
        files.mkdirs(where.getParent())
        if not files.rename(self._at(old)[1], where):
            raise OSError(f"cannot move {old} to {new}")

    def publish(self, path: str, text: str) -> None:
        """Write a small file that readers see whole or not at all."""
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        files, where = self._at(draft)
        stream = files.create(where, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        self.move(draft, path)

    def text(self, path: str) -> str:
        return self.spark.read.text(path, wholetext=True).first()[0]


@contextmanager
def scratch(spark: SparkSession, label: str):
    """A scratch folder that is removed at the end; use it where the result is read inside."""
    path = new_folder(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, max_bytes: int | None = None):
    """``df`` for two or more readers, worked out once and let go at the end.

    Spark persists it at ``level`` while the block runs; executors keep what fits in memory, and the others
    of the cluster read it from them. Where an executor is lost, its part is worked out again, so this suits frames
    that are cheap to repeat and readers that need not agree on anything random; :func:`durable` is for the
    others. With ``max_bytes`` the rows are measured first, and a frame above it is written to
    the shared folder instead (and removed at the end), as it would only push other data out of memory.
    """
    held = df.persist(level)
    path = None
    try:
        if max_bytes is not None and measured_bytes(held) > max_bytes:
            path = new_folder(df.sparkSession, "reused")
            held.write.parquet(path)
            held.unpersist()
            yield df.sparkSession.read.schema(df.schema).parquet(path)
        else:
            yield held
    finally:
        held.unpersist()
        if path:
            remove(df.sparkSession, path)


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to recompute after an executor is lost, every reader sees the
    same rows, and readers that need few columns scan only those.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
