"""Token ids in binary form: frequency-ranked codes, byte-aligned lengths, separate control bytes.

Every id is replaced by its rank among all ids by falling frequency, so that common ids need one
byte. A document's stream is a control part (two bits per id: how many bytes less one; four ids
to a byte, first id in the low bits) and a data part (the little-endian bytes themselves). The
decoder looks each control byte up in a table of 256 rows and gathers all bytes with numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratawork.workspace import new_folder

from .pieces import encoder
from .storage import ROW_BITS, Rows, binary_column, binary_values, kept, small_batches, written

# Fixed value: bytes of each of the four ids a control byte stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.int32)


def _places(counts: np.ndarray) -> np.ndarray:
    """Where the ids of each document stand if every document begins with a control byte of its own."""
    first = np.cumsum(counts) - counts
    bytes_before = np.cumsum(-(-counts // 4)) - -(-counts // 4)
    return np.arange(int(counts.sum())) + np.repeat(4 * bytes_before - first, counts)


def encode_streams(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes and how many of each belong to each document.

    ``codes`` are the unsigned 32-bit codes of all documents, ``counts`` how many each has.
    """
    codes, counts = np.ascontiguousarray(codes, "<u4"), np.asarray(counts, np.int64)
    lengths = np.ones(len(codes), np.uint8)
    for byte in range(1, 4):
        lengths += codes >= 1 << 8 * byte
    n_control = -(-counts // 4)
    spare = np.zeros(4 * int(n_control.sum()), np.uint8)
    spare[_places(counts)] = lengths - 1
    quads = spare.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = codes.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[np.cumsum(counts)]
    return control, data, n_control, np.diff(ends, prepend=0)


def decode_streams(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The codes of all documents written by :func:`encode_streams`."""
    lengths = LENGTHS[control].ravel()[_places(np.asarray(counts, np.int64))]
    codes = np.zeros((len(lengths), 4), np.uint8)
    codes[np.arange(4) < lengths[:, None]] = data
    return codes.view("<u4").ravel()


def encode_stream(codes: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit codes."""
    control, data, *_ = encode_streams(codes, [len(codes)])
    return control.tobytes(), data.tobytes()


def decode_stream(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` codes written by :func:`encode_stream`."""
    return decode_streams(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), [n])


def token_table(docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every whole text, ``end_id`` appended.

    NULL and empty texts have the end id alone. One pass, no shuffle; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            for at, ids in encode.columns(batch.column("text"), end_id):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(ids)), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """``id`` and ``n`` over all rows; a task hands on one row per id that it met."""
    schema = "id long, n long"

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            met = np.bincount(binary_values(batch.column("ids"), "<u4")[0])
            size = max(len(met), len(total))
            total = np.pad(total, (0, size - len(total))) + np.pad(met, (0, size - len(met)))
        out, ids = Rows(schema), np.nonzero(total)[0]
        out.columns = [ids.tolist(), total[ids].tolist()]
        yield out.batch()

    return tokens.select("ids").mapInArrow(run, schema).groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int | None = 0, folder: str | None = None) -> str:
    """Write the ids of ``docs`` in ascending ``doc_id`` (NULL last, ties in any order); the folder's path.

    ``streams`` holds one row per document in files cut by range (``pos`` rises with the order),
    ``codes`` the id of each rank: at most one row per entry of the vocabulary, which is what
    bounds the list that is sent to the tasks. Repeated rows are written as often as they come,
    an empty table gives an empty file.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    tokens = kept(token_table(docs, tokenizer, end_id), "tokens")
    ranked = sorted(id_counts(tokens).collect(), key=lambda r: (-r["n"], r["id"]))
    ids = np.array([r["id"] for r in ranked], np.int64)
    rank_of = np.zeros(int(ids.max(initial=0)) + 1, "<u4")
    rank_of[ids] = np.arange(len(ids))
    shared = spark.sparkContext.broadcast(rank_of)
    schema = "doc_id long, part int, n_tokens int, control binary, data binary"
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges of about equal size, found on the ids alone: a range partitioner would encode all rows to sample them
    steps = [k / files for k in range(1, files)]
    bounds = sorted({int(x) for x in tokens.approxQuantile("doc_id", steps, 0.1 / files)})

    def run(batches):
        for batch in batches:
            ids, ends = binary_values(batch.column("ids"), "<u4")
            counts = np.diff(ends, prepend=0)
            control, data, n_control, n_data = encode_streams(shared.value[ids], counts)
            doc = batch.column("doc_id")
            part = np.searchsorted(np.array(bounds, np.int64), doc.fill_null(0).to_numpy(), "right")
            part[doc.is_null().to_numpy(zero_copy_only=False)] = len(bounds)
            streams = [binary_column(control, np.cumsum(n_control)), binary_column(data, np.cumsum(n_data))]
            columns = [doc, pa.array(part, pa.int32()), pa.array(counts, pa.int32()), *streams]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "n_tokens", "control", "data"])

    order = F.col("doc_id").asc_nulls_last()
    streams = tokens.mapInArrow(run, schema).repartitionById(files, "part").sortWithinPartitions(order).drop("part")
    written(streams.withColumn("pos", F.monotonically_increasing_id()), f"{folder}/streams")
    codes = spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids)], "rank long, id long")
    codes.coalesce(1).write.parquet(f"{folder}/codes")
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``pos`` (rises with the written order), ``n_tokens`` and ``ids`` of every document in the files."""
    table = spark.read.parquet(f"{folder}/codes").orderBy("rank").collect()
    shared = spark.sparkContext.broadcast(np.array([r["id"] for r in table], "<u4"))
    schema = "doc_id long, pos long, n_tokens long, ids binary"

    def run(batches):
        for batch in batches:
            counts = batch.column("n_tokens").cast(pa.int64())
            control, data = (binary_values(batch.column(c), "u1")[0] for c in ("control", "data"))
            ids = binary_column(shared.value[decode_streams(control, data, counts.to_numpy())], np.cumsum(counts.to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("pos"), counts, ids], ["doc_id", "pos", "n_tokens", "ids"])

    return spark.read.parquet(f"{folder}/streams").mapInArrow(run, schema)


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before it, to rows with ``pos`` and ``n_tokens``.

    One sum per file, and a running sum inside each file's range. Select the columns you need
    first: the running sum shuffles them by file.
    """
    part = F.shiftright("pos", ROW_BITS)
    rows = kept(rows.withColumn("__part", part), "token-rows")
    before, total = {}, 0
    for part, n in sorted(rows.groupBy("__part").agg(F.sum("n_tokens")).collect()):
        before[part] = total
        total += n
    running = Window.partitionBy("__part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_tokens").over(running), F.lit(0))
    base = F.element_at(F.create_map(*[F.lit(v).cast("long") for p in before.items() for v in p]), F.col("__part")) if before else F.lit(0)
    return rows.withColumn("start", (base + inside).cast("long")).drop("__part")
