"""Incremental discovery of files in batch jobs, with a ledger of what was read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import broadcast_when_small
from ..workspace import Storage

FILE = "file_path string, file_size long, modified_at timestamp"
#: Files of one load; more wait for the next one, oldest first.
MAX_FILES = 10_000


class FileLedger:
    """Loads the files below a folder that were not read before, or that have changed since.

    A file is known by path, length and change time. Each load has a number; its rows go to
    ``rows/load=n`` and then its files to ``files/load=n``, which is its commit: a load that dies before
    is done again under its number and replaces what it left. Rows of a file that
    is read again replace those of its earlier load for readers.
    """

    def __init__(self, spark: SparkSession, source: str, base: str):
        self.spark, self.source, self.base = spark, source.rstrip("/"), base.rstrip("/")
        self.storage = Storage(spark)

    def _loads(self) -> list[int]:
        names = self.storage.names(f"{self.base}/files")
        return sorted(int(n.partition("=")[2]) for n in names if self.storage.exists(f"{self.base}/files/{n}/_SUCCESS"))

    def known(self) -> DataFrame:
        """Every file of every load with the number of the load."""
        folders = [f"{self.base}/files/load={n}" for n in self._loads()]
        schema = f"{FILE}, load long"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.base}/files").parquet(*folders)

    def listing(self) -> DataFrame:
        """The files there are now; their content is not opened."""
        if not self.storage.exists(self.source):
            return self.spark.createDataFrame([], FILE)
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.source)
        names = {"file_path": "file_path", "file_size": "file_size", "modified_at": "file_modification_time"}
        return found.select(*[F.col(f"_metadata.{c}").alias(n) for n, c in names.items()])

    def pending(self) -> DataFrame:
        """Files that are not in the ledger as they are now."""
        return self.listing().join(self.known(), ["file_path", "file_size", "modified_at"], "left_anti")

    def load(self, read: Callable[[list[str]], DataFrame], max_files: int = MAX_FILES) -> int:
        """Read the pending files with ``read(paths)`` and land their rows; how many files there were.

        The frame that ``read`` returns must be scanned from files, so that rows know their file.
        """
        files = self.pending().orderBy("modified_at", "file_path").limit(max_files).collect()
        if not files:
            return 0
        number = max(self._loads(), default=0) + 1
        rows = read([f.file_path for f in files])
        stamped = rows.select("*", F.col("_metadata.file_path").alias("source_path"))
        stamped.write.mode("overwrite").parquet(f"{self.base}/rows/load={number}")
        self.spark.createDataFrame(files, FILE).write.mode("overwrite").parquet(f"{self.base}/files/load={number}")
        return len(files)

    def rows(self) -> DataFrame | None:
        """Rows of the last load of every file, with ``source_path`` and ``load``; None before the first load."""
        loads = self._loads()
        if not loads:
            return None
        landed = self.spark.read.option("basePath", f"{self.base}/rows").parquet(*[f"{self.base}/rows/load={n}" for n in loads])
        last = self.known().groupBy(F.col("file_path").alias("last_path")).agg(F.max("load").alias("last_load"))
        newest = (F.col("source_path") == F.col("last_path")) & (F.col("load") == F.col("last_load"))
        return landed.join(broadcast_when_small(last), newest, "left_semi")
