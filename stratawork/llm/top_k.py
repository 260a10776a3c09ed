"""Exact top-k inner products of a query set against all vectors.

Rows are packed into tiles (a matrix and its ids). The candidates' tiles are dealt over shards,
the queries' tiles go to every shard, and each pair of tiles is one matrix product, of which a
query keeps its best k. Lists are merged in three layers: in a task over the tiles it meets, per
query and group of shards, and per query. Neither side is ever held whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .storage import Rows, kept

TILE = 1024
#: Shards of the candidates at least, and tiles of a shard on average beyond that; queries are sent to each shard.
SHARDS, SHARD_TILES = 64, 16
#: Groups in which the lists of a query are merged before the last merge.
MERGE_GROUPS = 8
#: Doubles hold whole numbers exactly up to here.
EXACT = 2.0**53


def tiles(vectors: DataFrame) -> DataFrame:
    """``tile``, ``dim``, ``n``, ``ids`` and ``matrix`` (doubles) of rows ``vec_id``, ``vector``, sorted by id inside a tile.

    Vectors of different lengths are never put into one tile.
    """
    schema = "dim int, n int, ids binary, matrix binary"

    def run(batches):
        out, held = Rows(schema), {}

        def close(dim, rows):
            rows.sort(key=lambda r: r[0])
            ids = np.array([r[0] for r in rows], np.int64).tobytes()
            matrix = np.array([r[1] for r in rows], np.float64).tobytes()
            out.add(dim, len(rows), ids, matrix, size=len(ids) + len(matrix))

        for batch in batches:
            for row in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                dim = len(row[1])
                held.setdefault(dim, []).append(row)
                if len(held[dim]) == TILE:
                    close(dim, held.pop(dim))
                    if out.full():
                        yield out.batch()
        for dim, rows in held.items():
            close(dim, rows)
        yield out.batch()

    packed = vectors.select("vec_id", "vector").mapInArrow(run, schema)
    return packed.withColumn("tile", F.monotonically_increasing_id())


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest finite scores of each row and their ids, ties to the smaller id; -inf fills up.

    ``ids`` ascend. Works on ``scores`` in place.
    """
    rows = np.arange(len(scores))
    top, who = np.full((len(scores), k), -np.inf), np.zeros((len(scores), k), np.int64)
    for place in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        top[:, place], who[:, place] = scores[rows, at], ids[at]
        scores[rows, at] = -np.inf
    return top, who


def merged(top, who, more, others, k):
    """The best k of two lists per row."""
    scores, ids = np.concatenate([top, more], axis=1), np.concatenate([who, others], axis=1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (long) for rows ``vec_id``, ``vector`` of whole numbers.

    A query is not its own candidate: rows with its ``vec_id`` are left out. Only vectors of the query's length are
    candidates. Rows that share a ``vec_id`` are candidates each; queries that do are one query, whose list
    has the best products of all its vectors. No rows on either side give no rows. Products beyond 2^53 cannot be told
    apart in doubles and are an error. Other columns are not read.
    """
    left, right = tiles(queries), tiles(candidates)
    shards = max(SHARDS, candidates.count() // (SHARD_TILES * TILE))
    left = left.select("dim", F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"))
    left = left.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = right.withColumn("shard", F.pmod(F.xxhash64("tile"), F.lit(shards)).cast("int")).drop("n", "tile")
    pairs = left.join(right, ["shard", "dim"]).select("shard", "dim", "q_tile", "q_ids", "q_matrix", "ids", "matrix")
    schema = pa.schema([("query_id", pa.int64()), ("shard", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def multiply(batches):
        lists = {}

        def close(shard, q_ids, top, who):
            row, place = np.nonzero(np.isfinite(top))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(q_ids[row]),
                    pa.array(np.full(len(row), shard, np.int32)),
                    pa.array(who[row, place]),
                    pa.array(top[row, place].astype(np.int64)),
                ],
                schema=schema,
            )

        for batch in batches:
            for i in range(batch.num_rows):
                shard, dim, q_tile = (batch.column(c)[i].as_py() for c in ("shard", "dim", "q_tile"))
                q_ids, ids = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("q_ids", "ids"))
                q, c = (np.frombuffer(batch.column(x)[i].as_buffer()).reshape(-1, dim) for x in ("q_matrix", "matrix"))
                if dim and np.abs(q).max(axis=0) @ np.abs(c).max(axis=0) >= EXACT:
                    raise ValueError("inner products exceed 2^53: scale the vectors down")
                scores = q @ c.T
                begin, end = np.searchsorted(ids, q_ids), np.searchsorted(ids, q_ids, "right")
                for row in np.flatnonzero(begin < end):
                    scores[row, begin[row] : end[row]] = -np.inf
                top, who = best(scores, ids, k)
                key = (shard, q_tile)
                if key in lists:
                    top, who = merged(*lists[key][1:], top, who, k)
                elif len(lists) >= 64:
                    old = next(iter(lists))
                    yield close(old[0], *lists.pop(old))
                lists[key] = (q_ids, top, who)
        for (shard, _), held in lists.items():
            yield close(shard, *held)

    found = pairs.mapInArrow(multiply, "query_id long, shard int, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id")]
    grouped = Window.partitionBy("query_id", "group").orderBy(*order)
    found = found.withColumn("group", F.col("shard") % MERGE_GROUPS).withColumn("rank", F.row_number().over(grouped)).filter(F.col("rank") <= k)
    last = Window.partitionBy("query_id").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def whole_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """``vec_id`` and ``vector`` with each component x as floor(scale * x).

    Rows without ``vec_id`` and vectors that are NULL or hold NULL or non-finite components take no part. Repeated
    rows stay, as do rows that share an id.
    """
    values = F.col("embedding").cast("array<double>")
    rows = vectors.filter("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long"), values.alias("vector"))
    rows = rows.filter(~F.exists("vector", lambda x: F.isnull(x) | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(scale)).cast("double")))


def top_k_of_every(vectors: DataFrame, every: int, k: int = 5) -> DataFrame:
    """The queries are the rows whose ``vec_id`` is divisible by ``every``; all rows are candidates."""
    rows = kept(whole_vectors(vectors), "whole-vectors")
    return top_k(rows.filter(F.col("vec_id") % every == 0), rows, k)
