"""Best-fit packing of token pieces into sequences of bounded length, in bulk-synchronous steps.

Pieces are range-sorted by length. Pieces of one length are interchangeable, and so are gaps
of one size; a run (size, first rank, how many) stands for all of them. In each step the
longest unplaced length sweeps the gap runs for its successor (the smallest gap that holds
it), pieces and gaps of both runs are paired in rank order, the gaps shrink, and the sweep
goes on; where no gap fits, new sequences open. Filling a gap makes it the tightest for the
next piece of that length, so whole multiples are placed at once. This gives the placements of
sequential best-fit decreasing.

The state of a sweep is bounded by the sequence length, never by the number of documents, so it
runs over the counts by length. Sorting, ranking and placing the pieces are Spark jobs.
"""

from __future__ import annotations

import bisect
import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .pieces import encoder
from .storage import Rows, kept, numbered, small_batches, text_rows


def sweep(counts: dict[int, int], limit: int) -> np.ndarray:
    """Placement runs of pieces given as {length: how many}, lengths below or at ``limit``.

    Rows (length, first piece rank, pieces, first sequence, pieces per sequence, offset): piece
    ``first + i`` of that length goes to sequence ``first sequence + i // per`` at
    ``offset + i % per * length``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    runs, opened = [], 0

    def add(room: int, start: int, many: int) -> None:
        if room and many:
            if room not in gaps:
                gaps[room] = []
                bisect.insort(sizes, room)
            heapq.heappush(gaps[room], (start, many))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                many = -(-left // (limit // length))
                add(limit, opened, many)
                opened += many
                continue
            room = sizes[at]
            start, many = heapq.heappop(gaps[room])
            if not gaps[room]:
                del gaps[room], sizes[at]
            per = room // length
            whole = min(many, left // per)
            if whole:
                runs.append((length, rank, whole * per, start, per, limit - room))
                add(room - per * length, start, whole)
                rank, left = rank + whole * per, left - whole * per
            if whole < many and left:
                # fewer pieces than one gap takes
                runs.append((length, rank, left, start + whole, left, limit - room))
                add(room - left * length, start + whole, 1)
                whole, left = whole + 1, 0
            add(room, start + whole, many - whole)
    return np.array(runs, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, limit: int, order: list[str]) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``limit``) with ``sequence_id`` and ``offset``.

    ``order`` names the columns that rank pieces of equal length. Repeated rows are placed each
    on its own. An empty table gives an empty result; a length outside the bounds is an error.
    """
    spark = pieces.sparkSession
    ranked = numbered(pieces, [F.col("length").desc(), *map(F.col, order)], "pieces-ranked")
    counts = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= limit:
        raise ValueError(f"piece lengths must lie between 1 and {limit}")
    runs = sweep(counts, limit)
    first, before = {}, 0
    for length in sorted(counts, reverse=True):
        first[length] = before
        before += counts[length]
    runs[:, 1] += np.array([first[n] for n in runs[:, 0]], np.int64)
    shared = spark.sparkContext.broadcast(runs[np.argsort(runs[:, 1])])

    def place(frames):
        for frame in frames:
            run = shared.value[np.searchsorted(shared.value[:, 1], frame["rank"].to_numpy(), "right") - 1]
            step = frame["rank"].to_numpy() - run[:, 1]
            frame["sequence_id"] = run[:, 3] + step // run[:, 4]
            frame["offset"] = run[:, 5] + step % run[:, 4] * run[:, 0]
            yield frame.drop(columns="rank")

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return ranked.mapInPandas(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def token_pieces(docs: DataFrame, tokenizer: str, limit: int, end_id: int = 0) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` of every document with ``end_id`` appended.

    Only documents longer than ``limit`` are cut. NULL and empty texts have the end id alone;
    other columns are ignored. Ids are little-endian unsigned 32-bit.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"
    end, step = np.array([end_id], "<u4").tobytes(), 4 * limit

    def run(batches):
        encode, out = encoder(tokenizer), Rows(schema)
        for doc, text in text_rows(batches, "doc_id"):
            ids = encode.ids(text) + end
            for piece, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                out.add(doc, piece, at // 4, len(part) // 4, part, zlib.crc32(part), size=len(part) + 48)
            if out.full():
                yield out.batch()
        yield out.batch()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def packed_documents(docs: DataFrame, tokenizer: str, limit: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Every piece of ``docs`` with its place; ``ids`` come along unless ``with_ids`` is false."""
    pieces = token_pieces(docs, tokenizer, limit, end_id)
    if not with_ids:
        pieces = pieces.drop("ids")
    return pack(kept(pieces, "pieces"), limit, ["doc_id", "piece"])
