"""Streaming forms of the batch operators."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import money_mean, money_sum
from ..operators.cleanse import remove_duplicates
from ..workspace import Storage, new_folder

#: Files of one micro-batch, so that a backlog is not one batch.
MAX_FILES = 1000


def rate_columns(df: DataFrame) -> DataFrame:
    """Derived transaction columns of a ``(timestamp, value)`` rate stream."""
    value = F.col("value")
    # Offsets and periods of the derived numbers.
    return df.select(
        (value + 3000).alias("transaction_id"),
        (value % 3 + 101).alias("product_id"),
        (value % 5 + 701).alias("customer_id"),
        (value % 100 + 50).alias("amount"),
        F.col("timestamp").alias("transaction_date"),
    )


def rate_source(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    stream = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate_columns(stream)


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = MAX_FILES,
    **options,
) -> DataFrame:
    """Files not seen before; the checkpoint of the query remembers those already read.

    A micro-batch takes ``max_files_per_trigger`` files at most (None: all that there are).
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def append_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything available to files, exactly once per checkpoint, then stop."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def tumbling(
    df: DataFrame,
    ts: str,
    keys: list[str],
    amount: str,
    *,
    width: str = "7 days",
    lateness: str | None = None,
) -> DataFrame:
    """Windowed revenue and count; with ``lateness`` rows behind the watermark are ignored."""
    source = df.withWatermark(ts, lateness) if lateness else df
    grouped = source.groupBy(F.window(ts, width).alias("w"), *keys)
    return grouped.agg(money_sum(amount).alias("revenue"), F.count("*").alias("events")).select(
        F.col("w.start").alias("window_start"), *keys, "revenue", "events"
    )


def running_state(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Keyed totals kept by the state store, for ``update`` or ``complete`` output."""
    return df.groupBy(key).agg(
        money_sum(amount).alias("lifetime_value"),
        F.count("*").alias("total_transactions"),
        money_mean(amount).alias("avg_transaction_amount"),
    )


def each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "update",
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_result(spark: SparkSession, stream: DataFrame, label: str, output_mode: str = "complete") -> DataFrame:
    """Run an aggregating stream over everything available; the last full result as a table.

    Every batch writes its result to a folder of its own in shared storage, so a repeated
    batch replaces itself and nothing passes through the driver.
    """
    out = new_folder(spark, label)
    last = {}

    def keep(batch: DataFrame, batch_id: int) -> None:
        last["path"] = f"{out}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(last["path"])

    each_batch(stream, keep, new_folder(spark, f"{label}-checkpoint"), output_mode).awaitTermination()
    if not last:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(last["path"])


def deliver(spark: SparkSession, parts: list[DataFrame], start: Callable[[DataFrame], StreamingQuery], label: str = "deliveries") -> None:
    """Land ``parts`` one after the other in a folder and run the stream that ``start`` makes after each of them.

    A part may be any number of files; the checkpoint that ``start`` names tells old files from new ones.
    """
    path = new_folder(spark, label)
    for part in parts:
        part.write.mode("append").parquet(path)
        start(new_files(spark, path, part.schema)).awaitTermination()


class BatchLog:
    """Append sink with one folder per batch.

    A batch that is run again, because it died before its commit, writes the same rows to the same folder. Hence
    no row is lost or there twice, which appending in ``foreachBatch`` could not promise.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema
        self.storage = Storage(spark)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.base}/_batch={batch_id}")

    def batches(self) -> list[int]:
        """Numbers of the batches written as a whole."""
        names = [n for n in self.storage.names(self.base) if n.startswith("_batch=")]
        return sorted(int(n.partition("=")[2]) for n in names if self.storage.exists(f"{self.base}/{n}/_SUCCESS"))

    def _stored(self, batches: list[int], folders: list[str] = ()) -> DataFrame:
        """Rows of the named batches and folders with the number of their batch in ``_batch``."""
        schema = T.StructType([*self.schema.fields, T.StructField("_batch", T.LongType())])
        parts = []
        if batches:
            reader = self.spark.read.schema(schema).option("basePath", self.base)
            parts.append(reader.parquet(*[f"{self.base}/_batch={n}" for n in batches]))
        if folders:
            parts.append(self.spark.read.schema(schema).parquet(*folders))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        return self._stored(self.batches()).drop("_batch")


@dataclass(frozen=True)
class Merged:
    """A folder that stands for the batches ``first`` to ``last``."""

    folder: str
    level: int
    first: int
    last: int


class UpsertLog(BatchLog):
    """Upsert sink whose cost follows the batch and not the table.

    Batch *n* writes its newest row per key to a folder of its own; a replayed batch rewrites
    that folder from the same input, so the sink is effectively exactly-once. Reading takes, per
    key, the last row by ``order_by``, whatever batch brought it; the later batch wins ties.

    :meth:`compact` merges folders by levels: ``fanout`` neighbours of a level become one folder of the next, with the
    newest row per key, so a row is rewritten once per level and a reader meets few folders. The
    list of live folders is a manifest of a new version, published by a rename after all else is written; a reader
    takes the newest version it finds, and batches after it. Merged folders stay until :meth:`vacuum`,
    so a frame that was read before goes on.
    """

    def __init__(
        self, spark: SparkSession, base: str, schema: T.StructType, keys: list[str], order_by: list[str], fanout: int = 8
    ):
        super().__init__(spark, base, schema)
        self.keys, self.order_by, self.fanout = keys, order_by, fanout

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        super().__call__(remove_duplicates(batch, self.keys, keep="last", order_by=self.order_by), batch_id)

    def _versions(self) -> list[int]:
        names = self.storage.names(f"{self.base}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self) -> list[Merged]:
        """The merged folders of the newest version, oldest batches first."""
        versions = self._versions()
        if not versions:
            return []
        return [Merged(**entry) for entry in json.loads(self.storage.text(f"{self.base}/manifest/{versions[-1]}.json"))]

    def live(self) -> list[Merged]:
        """All that a reader must read: merged folders and the batches behind them, at level 0."""
        merged = self.manifest()
        done = max([m.last for m in merged], default=-1)
        return merged + [Merged(f"{self.base}/_batch={n}", 0, n, n) for n in self.batches() if n > done]

    def _rows(self, parts: list[Merged]) -> DataFrame:
        rows = self._stored([p.first for p in parts if not p.level], [p.folder for p in parts if p.level])
        return remove_duplicates(rows, self.keys, keep="last", order_by=[*self.order_by, "_batch"])

    def read(self) -> DataFrame:
        return self._rows(self.live()).drop("_batch")

    def compact(self) -> int:
        """Merge every level that holds ``fanout`` folders; how many folders were written."""
        parts, written, level = self.live(), 0, 0
        while level <= max([p.level for p in parts], default=-1):
            # levels fall from the oldest batches to the newest, so those of one level are neighbours
            own = [p for p in parts if p.level == level]
            whole = len(own) // self.fanout * self.fanout
            for k in range(0, whole, self.fanout):
                group = own[k : k + self.fanout]
                folder = f"{self.base}/merged/{group[0].first}-{group[-1].last}-{uuid.uuid4().hex}"
                self._rows(group).write.parquet(folder)
                at = parts.index(group[0])
                parts[at : at + len(group)] = [Merged(folder, level + 1, group[0].first, group[-1].last)]
                written += 1
            level += 1
        if written:
            version = max(self._versions(), default=0) + 1
            entries = [asdict(p) for p in parts if p.level]
            self.storage.publish(f"{self.base}/manifest/{version}.json", json.dumps(entries))
        return written

    def vacuum(self) -> int:
        """Delete the folders that the newest manifest replaced, and older manifests; how many folders went."""
        merged = self.manifest()
        if not merged:
            return 0
        live = {m.folder.rsplit("/")[-1] for m in merged}
        gone = [f"merged/{n}" for n in self.storage.names(f"{self.base}/merged") if n not in live]
        gone += [f"_batch={n}" for n in self.batches() if n <= merged[-1].last]
        for version in self._versions()[:-1]:
            self.storage.delete(f"{self.base}/manifest/{version}.json")
        for name in gone:
            self.storage.delete(f"{self.base}/{name}")
        return len(gone)
