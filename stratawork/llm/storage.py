"""Written stages and Arrow output shared by the corpus operators."""

from __future__ import annotations

from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratawork.workspace import new_folder, remove

#: Bytes of output a task gathers before it hands a batch to Spark.
BATCH_BYTES = 8 << 20
#: Rows of a partition are numbered in the low bits of ``monotonically_increasing_id``.
ROW_BITS = 33


#: Lets Spark remove a query's shuffle files as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str) -> str:
    """Write ``df`` as parquet; its shuffle files, which nothing reads again, go at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)
    return path


#: Scopes of the running thread, the innermost last.
_SCOPES: ContextVar[tuple["Scope", ...]] = ContextVar("scopes", default=())


class Scope:
    """Removes the tables that :func:`kept` writes inside the block as the block ends.

    What the block returns must be read from tables written with :meth:`hand_on`, which belong to the scope around
    it; without one they stay.
    """

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "Scope":
        self.outer = _SCOPES.get()
        _SCOPES.set((*self.outer, self))
        return self

    def __exit__(self, *_) -> None:
        _SCOPES.set(self.outer)
        for path in self.paths:
            remove(self.spark, path)

    def hand_on(self, df: DataFrame, label: str) -> DataFrame:
        return _table(df, label, self.outer)


def _table(df: DataFrame, label: str, scopes: tuple[Scope, ...]) -> DataFrame:
    path = new_folder(df.sparkSession, label)
    if scopes:
        scopes[-1].paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(written(df, path))


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and gives all readers the same rows.
    """
    return _table(df, label, _SCOPES.get())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with marks in front until it is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


#: Arrow types of the column types that operators declare.
ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<struct<at:int,before:int>>": pa.list_(pa.struct([("at", pa.int32()), ("before", pa.int32())])),
}


def small_batches(spark) -> None:
    """Have Spark hand texts to Python in batches of 16 MB at most: several are held at once on either side."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key)).rstrip("b")) > 16 << 20:
        spark.conf.set(key, str(16 << 20))


class Rows:
    """Collects output rows of a task and turns them into Arrow batches of bounded size.

    ``schema`` is the ``name type, name type`` text that is also given to Spark.
    """

    def __init__(self, schema: str):
        self.schema = pa.schema([(name, ARROW[kind]) for name, kind in (f.split(" ") for f in schema.split(", "))])
        self.columns: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, *values, size: int = 64) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.bytes += size

    def full(self) -> bool:
        return self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
        self.columns = [[] for _ in self.schema]
        self.bytes = 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def binary_column(values: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Rows that end at ``ends`` (in elements) of ``values``."""
    offsets = np.zeros(len(ends) + 1, np.int64)
    offsets[1:] = ends
    offsets *= values.itemsize
    if offsets[-1] >= 1 << 31:
        raise ValueError("a row takes more than 2 GB")
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def binary_values(column: pa.BinaryArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All rows of a column without NULL as one array of numpy type ``kind``, and where each ends."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(kind)
    return values, (offsets[1:] - offsets[0]) // values.itemsize


def text_rows(batches, key: str | tuple[str, ...], text: str = "text"):
    """(key, text) of each row of the Arrow batches; a few hundred rows at a time become Python objects.

    With several key columns the key is a tuple.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            if isinstance(key, str):
                keys = part.column(key).to_pylist()
            else:
                keys = list(zip(*[part.column(k).to_pylist() for k in key]))
            yield from zip(keys, part.column(text).to_pylist())


def numbered(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows sorted over the whole table, with ``rank`` (from 0) as a new column; written once.

    Rows are cut by range and sorted inside partitions. Only one count per partition passes
    through the driver, so no task sees more than its own range.
    """
    placed = kept(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__pos", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("__pos", ROW_BITS)
    sizes = placed.groupBy(part.alias("part")).count().collect()
    offsets, total = {}, 0
    for row in sorted(sizes):
        offsets[row["part"]] = total
        total += row["count"]
    row = F.col("__pos").bitwiseAND((1 << ROW_BITS) - 1)
    if not offsets:
        return placed.withColumn("rank", row).drop("__pos")
    table = F.create_map(*[F.lit(v).cast("long") for pair in offsets.items() for v in pair])
    return placed.withColumn("rank", F.element_at(table, part) + row).drop("__pos")
