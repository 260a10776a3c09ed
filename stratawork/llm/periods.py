"""Runs of periodic words by internal pattern matching.

A run is a stretch of words with smallest period q, of ``max(min_length, min_exponent * q)`` words or
more, that no neighbouring word extends. Take the level k of 1 or more with 2^(k-1) < q <= 2^k (1 for q = 1).
A run of exponent 4 holds a dyadic block, one of the blocks of 2^k words that start at multiples of 2^k, with
q words of the run before or behind it. The block has q words or more, and the run's root is no power, so
the block occurs inside the run at distances that are multiples of q and nowhere else: its nearest occurrence
on that side is q away. So of each block only the nearest occurrences within 2^k words, on both sides, are asked for;
equal distances on both sides are a progression. The distance is a candidate period.

* A suffix array by prefix doubling; at the round of 2^k words equal blocks are an interval of it.
* A wavelet tree over the suffix array answers range successor and predecessor: the place of a
  block among the positions in its interval, then the positions next to it in order.
* Candidates are extended word by word, each run once per period.

All steps work on arrays of many documents at once. Words of different documents are different
symbols, so no interval holds two documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import BATCH_BYTES, small_batches, text_rows

#: Words after which a task searches the documents it has gathered.
BATCH_WORDS = 1 << 17
#: Distinct words a task numbers before it starts anew.
NUMBERED_WORDS = 1 << 19


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class WaveletTree:
    """Order statistics of any interval of an array of numbers from 0 to its length - 1."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            zeros = np.concatenate([[0], np.cumsum(~ones)]).astype(np.int32)
            self.levels.append((bit, zeros))
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers in [low, high) are smaller than ``value``."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros in self.levels:
            left, right, total = zeros[low], zeros[high], zeros[-1]
            up = (value >> bit & 1).astype(bool)
            count += np.where(up, right - left, 0)
            low, high = np.where(up, total + low - left, left), np.where(up, total + high - right, right)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number with ``k`` smaller ones in [low, high)."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros in self.levels:
            left, right, total = zeros[low], zeros[high], zeros[-1]
            up = k >= right - left
            k = np.where(up, k - (right - left), k)
            value |= up.astype(np.int64) << bit
            low, high = np.where(up, total + low - left, left), np.where(up, total + high - right, right)
        return value


def suffix_levels(symbols: np.ndarray, ends: np.ndarray):
    """The suffix array of documents that lie one behind the other, and by level its repeated prefixes.

    ``ends`` has for each position where its document ends; ``symbols`` differ between documents. A
    level (length, positions, interval starts, interval stops) has the positions whose prefix of that length
    occurs again, and the interval of the suffix array with that prefix.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    levels, length, slots, keys = [], 1, np.arange(n), symbols[order]
    suffixes = order.copy()
    while True:
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        first = np.repeat(slots[starts], sizes)
        rank[order] = first
        again = np.repeat(sizes > 1, sizes)
        slots, order, first = slots[again], order[again], first[again]
        if not len(slots):
            return suffixes, levels
        if length > 1:
            levels.append((length, order, first, first + np.repeat(sizes, sizes)[again]))
        ahead = order + length
        second = np.where(ahead < ends[order], rank[np.minimum(ahead, n - 1)], -1)
        keys = first * (n + 1) + second + 1
        by = np.argsort(keys, kind="stable")
        order, keys = order[by], keys[by]
        suffixes[slots] = order
        length *= 2


def candidates(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of blocks and their nearest occurrences: the words from there on repeat after ``distance``."""
    suffixes, levels = suffix_levels(symbols, ends)
    none = np.zeros(0, np.int64)
    if not levels:
        return none, none
    # only suffixes whose first two words occur again can lie in an interval that is asked for
    _, held, low, high = levels[0]
    used = np.zeros(len(symbols) + 1, np.int64)
    lows = np.unique(low)
    highs = high[np.searchsorted(low, lows)]
    edges = np.zeros(len(symbols) + 1, np.int64)
    edges[lows] += 1
    edges[highs] -= 1
    slots = np.cumsum(edges)[:-1] > 0
    used[1:] = np.cumsum(slots)
    positions = np.sort(held)
    tree = WaveletTree(np.searchsorted(positions, suffixes[slots]))
    found_at, found_by = [none], [none]
    for length, at, low, high in levels:
        aligned = (at - starts[at]) % length == 0
        at, low, high = at[aligned], used[low[aligned]], used[high[aligned]]
        own = np.searchsorted(positions, at)
        place = tree.below(low, high, own)
        for side in (1, -1):
            near = place + side
            there = (near >= 0) & (near < high - low)
            other = positions[tree.smallest(low[there], high[there], near[there])]
            distance = np.abs(other - at[there])
            fits = (distance <= length) & ((2 * distance > length) | (length == 2))
            found_at.append(np.minimum(at[there], other)[fits])
            found_by.append(distance[fits])
    return np.concatenate(found_at), np.concatenate(found_by)


def extended(w: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch around ``at`` inside [low, high) whose words are those ``period`` before."""
    right, step = at, 64
    while right + period < high:
        m = min(step, high - period - right)
        other = np.flatnonzero(w[right : right + m] != w[right + period : right + period + m])
        if len(other):
            right += int(other[0])
            break
        right, step = right + m, 2 * step
    left, step = at, 64
    while left > low:
        m = min(step, left - low)
        other = np.flatnonzero(w[left - m : left] != w[left - m + period : left + period])
        if len(other):
            left -= m - 1 - int(other[-1])
            break
        left, step = left - m, 2 * step
    return left, right + period


def find_runs(texts: list[np.ndarray], min_length: int = 6, min_exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text (numbers of its words), by start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.concatenate(texts) if len(texts) else np.zeros(0, np.int64)
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(words):
        return result
    stops = np.cumsum(sizes)
    of = np.repeat(np.arange(len(texts)), sizes)
    starts, ends = (stops - sizes)[of], stops[of]
    at, by = candidates(of * (int(words.max()) + 1) + words, starts, ends)
    order = np.lexsort((at, by, of[at]))
    last = (-1, 0, 0)
    for x, period in zip(at[order].tolist(), by[order].tolist()):
        doc, low = int(of[x]), int(starts[x])
        if last[:2] == (doc, period) and x < last[2]:
            continue
        left, right = extended(words, x, period, low, int(ends[x]))
        # the words from ``right - period`` on do not repeat, so a later stretch may start there
        last = (doc, period, right - period)
        if right - left >= max(min_length, min_exponent * period):
            result[doc].append((left - low, right - left, period))
    return [sorted(set(r), key=lambda run: (run[0], run[2])) for r in result]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds behind its first period, with one blank between them."""
    if not runs:
        return b" ".join(words).decode()
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(stays).tolist()]).decode()


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (``start``, ``length``, ``period``; by start, then period) and ``text`` for every row.

    Words are runs of bytes other than ASCII blanks, as they are written. ``text`` has the words that no run holds after its first
    ``period`` words, with one blank between them.

    NULL and empty texts have no words, no runs and the text ''. Repeated rows have one result each; a NULL
    ``doc_id`` stays NULL; an empty table gives an empty result; other columns are neither read nor returned.
    """
    if min_exponent < 4:
        raise ValueError("a block with a whole period beside it is certain from exponent 4 on")
    small_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("text", pa.string())])

    def rows(held):
        """Arrow batches of the results of some documents (key, words, their numbers)."""
        part, size = [], 0
        for (doc, words, _), found in zip(held, find_runs([h[2] for h in held], min_length, min_exponent)):
            text = collapsed(words, found)
            part.append((doc, len(words), [dict(zip(("start", "length", "period"), r)) for r in found], text))
            size += len(text)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
                part, size = [], 0
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    def search(batches):
        numbers, held, n = _Numbers(), [], 0
        for doc, text in text_rows(batches, "doc_id"):
            words = (text or "").encode().split()
            if len(numbers) > NUMBERED_WORDS:
                yield from rows(held)
                numbers, held, n = _Numbers(), [], 0
            held.append((doc, words, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))))
            n += len(words)
            if n >= BATCH_WORDS or len(held) >= BATCH_WORDS:
                yield from rows(held)
                held, n = [], 0
        yield from rows(held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, text string")
