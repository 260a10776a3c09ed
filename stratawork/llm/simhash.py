"""SimHash near duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits (the last filled up with
zeros). The perfect Golay code has a codeword within 3 bits of any 23-bit word. If two segments
differ in at most 2 bits, a word between them lies within 1 bit of both, so its codeword lies
within 4 bits of both. A segment's keys are the indices of all codewords within 4 bits: one, or
six. Of 4 differing bits over three segments, at most one segment has 3 or more, so two
fingerprints that link share the keys of some two segments; that pair of keys is a bucket of
2^24. Every pair in a bucket is verified by its differing bits.

Copies of a fingerprint are one row before keys are made. A bucket hands on stars (one edge per
row at most) instead of all its pairs. Buckets above ``BLOCK`` rows are cut into blocks, and every
two blocks meet in a task of their own, so no bucket size is out of reach and nothing is dropped.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .components import components, star_edges
from .storage import Rows, fresh, kept, small_batches, text_rows

#: Rows of a bucket that one task compares with each other.
BLOCK = 2048
#: Links of larger groups of a bucket are handed on as stars.
SMALL = 8
# Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the (23,12) code.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """Bits set in over half the hashes of the text's word shingles; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = words[at : at + 65536 + shingle - 1]
        if len(words) < shingle:
            hashes = [xxhash.xxh64_intdigest(b" ".join(part), seed)]
        else:
            hashes = [xxhash.xxh64_intdigest(b" ".join(s), seed) for s in zip(*[part[k:] for k in range(shingle)])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (the 64 bits as a signed long) of every whole text.

    Words are runs of bytes other than blanks, A-Z in lower case. NULL texts have no words, so
    like empty ones they get 0.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, text_hash long, fp long"

    def run(batches):
        out = Rows(schema)
        for (doc, digest), text in text_rows(batches, ("doc_id", "text_hash")):
            value = fingerprint(text or "", shingle, seed)
            out.add(doc, digest, value - (value >> 63 << 64))
            if out.full():
                yield out.batch()
        yield out.batch()

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, schema)


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits, and per remainder the error words of up to 4 bits (-1: none)."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << bit - 11
        return word

    single = [remainder(1 << b) for b in range(23)]
    errors: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            rest = word = 0
            for b in bits:
                rest ^= single[b]
                word |= 1 << b
            errors[rest].append(word)
    table = np.full((2048, 6), -1, np.int64)
    for rest, words in enumerate(errors):
        table[rest, : len(words)] = words
    return np.array([remainder(u << 11) for u in range(4096)], np.int64), table


def segment_keys(words: np.ndarray, upper: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of each 23-bit word, six columns, -1 for none."""
    found = errors[upper[words >> 11] ^ (words & 2047)]
    return np.where(found < 0, -1, (words[:, None] ^ found) >> 11)


def bucket_keys(fps: np.ndarray, upper: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of the fingerprint, bucket) for all buckets of all fingerprints."""
    bits = fps.astype(np.int64).view(np.uint64)
    keys = [segment_keys((bits >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64), upper, errors) for s, w in SEGMENTS]
    rows, buckets = [], []
    for pair, (i, j) in enumerate(combinations(range(3), 2)):
        first, second = keys[i][:, :, None], keys[j][:, None, :]
        at, x, y = np.nonzero((first >= 0) & (second >= 0))
        rows.append(at)
        buckets.append(pair << 24 | keys[i][at, x] << 12 | keys[j][at, y])
    return np.concatenate(rows), np.concatenate(buckets)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of signed 64-bit words."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _stars(fps: np.ndarray, distance: int, split: int | None = None, edges_of=None) -> tuple[np.ndarray, ...]:
    """Star edges of the links among ``fps``; with ``split`` only of links across that position.

    ``edges_of`` may be :func:`_direct`, whose marks come third.
    """
    left, right = [], []
    for at in range(0, len(fps) if split is None else split, 512):
        rows = fps[at : at + 512] if split is None else fps[at : min(at + 512, split)]
        cols = fps if split is None else fps[split:]
        i, j = np.nonzero(differing(rows[:, None], cols[None, :]) <= distance)
        left.append(i + at)
        right.append(j + (split or 0))
    left, right = np.concatenate(left), np.concatenate(right)
    if edges_of:
        low, other, marks = edges_of(left, right, len(fps))
        return fps[low], fps[other], marks
    low, other = star_edges(left, right, len(fps))
    return fps[low], fps[other]


def _direct(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links as they are in components of up to ``SMALL`` nodes, else star edges, which are marked."""
    low, other = star_edges(left, right, n)
    root = np.arange(n)
    root[other] = low
    wide = (np.bincount(root, minlength=n) > SMALL)[root]
    some, star = ~wide[left] & (left < right), wide[other]
    marks = np.concatenate([np.zeros(some.sum(), bool), np.ones(star.sum(), bool)])
    return np.concatenate([left[some], low[star]]), np.concatenate([right[some], other[star]]), marks


def keyed(fps: DataFrame) -> DataFrame:
    """``bucket`` and ``fp`` for all buckets of every row's fingerprint."""
    key_schema = pa.schema([("bucket", pa.int64()), ("fp", pa.int64())])

    def keys(batches):
        tables = golay_tables()
        for batch in batches:
            values = batch.column("fp").to_numpy()
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                rows, buckets = bucket_keys(part, *tables)
                yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(part[rows])], schema=key_schema)

    return fps.select("fp").mapInArrow(keys, "bucket long, fp long")


def links(fps: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``fp``) with the components of all links.

    Every link at ``distance`` (4 at most) or fewer bits lies inside a component of these edges, and
    every edge lies inside a component of links.
    """
    if not 0 <= distance <= 4:
        raise ValueError("two segments with at most 2 errors are certain up to 4 differing bits")
    return bucket_links(fps, distance, block)


def bucket_links(fps: DataFrame, distance: int, block: int = BLOCK, marked: bool = False) -> DataFrame:
    """As :func:`links` at any ``distance``, for the links that share a bucket.

    With ``marked`` groups of up to ``SMALL`` fingerprints in a bucket hand on all their links, larger ones
    stars as before, whose edges (links or not) have ``star`` set.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int64()), ("block", pa.int32()), ("star", pa.bool_())])
    edges_of = _direct if marked else None

    def edges(a, b, star=None):
        none = pa.nulls(len(a))
        star = np.zeros(len(a), bool) if star is None else star
        arrays = [pa.array(a), pa.array(b), none.cast(pa.int64()), none.cast(pa.int32()), pa.array(star)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def compare(batches):
        """Sorted rows of whole buckets; the last bucket of a batch waits for its further rows."""
        held_key, held, blocks = None, np.zeros(0, np.int64), 0

        def close():
            if blocks:
                yield from defer(held)
            elif len(held) > 1:
                yield edges(*_stars(held, distance, None, edges_of))

        def defer(rows):
            n = len(rows)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.nulls(n).cast(pa.int64()), pa.array(np.full(n, held_key)), pa.array(np.full(n, blocks, np.int32)), pa.array(np.zeros(n, bool))],
                    schema=schema,
                )

        for batch in batches:
            key, fp = batch.column("bucket").to_numpy(), batch.column("fp").to_numpy()
            while len(key):
                if key[0] != held_key:
                    yield from close()
                    held_key, held, blocks = key[0], np.zeros(0, np.int64), 0
                    last = np.searchsorted(key, key[-1])
                    if last:
                        yield from small_buckets(key[:last], fp[:last])
                        key, fp = key[last:], fp[last:]
                        held_key = key[0]
                end = np.searchsorted(key, held_key, "right")
                held = np.concatenate([held, fp[:end]])
                key, fp = key[end:], fp[end:]
                while len(held) > block:
                    yield from defer(held[:block])
                    held, blocks = held[block:], blocks + 1
        yield from close()

    def small_buckets(key, fp):
        """Whole buckets of one batch: rows are compared with the next ones of their bucket."""
        starts = np.nonzero(np.r_[True, key[1:] != key[:-1]])[0]
        sizes = np.diff(np.r_[starts, len(key)])
        big = sizes > 8
        for at, n in zip(starts[big], sizes[big]):
            for low in range(0, n, block):
                yield edges(*_stars(fp[at + low : at + min(n, low + block)], distance, None, edges_of))
                for up in range(low + block, n, block):
                    both = np.concatenate([fp[at + low : at + low + block], fp[at + up : at + min(n, up + block)]])
                    yield edges(*_stars(both, distance, block, edges_of))
        small = np.repeat(~big, sizes)
        key, fp = key[small], fp[small]
        for step in range(1, 8):
            same = np.nonzero(key[step:] == key[:-step])[0]
            if not len(same):
                break
            near = same[differing(fp[same], fp[same + step]) <= distance]
            if len(near):
                yield edges(fp[near], fp[near + step])

    text = "a long, b long, bucket long, block int, star boolean"
    found = kept(keyed(fps).repartition("bucket").sortWithinPartitions("bucket", "fp").mapInArrow(compare, text), "simhash-links")

    late = found.filter("bucket is not null").select("bucket", "block", F.col("a").alias("fp"))
    counts = late.groupBy("bucket").agg((F.max("block") + 1).alias("blocks")).withColumnRenamed("bucket", "of")
    met = late.join(counts, late["bucket"] == counts["of"])
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = met.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "fp")

    def two_blocks(frame):
        import pandas as pd

        low = frame.loc[frame["block"] == frame["low"], "fp"].to_numpy()
        high = frame.loc[frame["block"] != frame["low"], "fp"].to_numpy()
        same = frame["low"].iat[0] == frame["high"].iat[0]
        found = _stars(low, distance, None, edges_of) if same else _stars(np.concatenate([low, high]), distance, len(low), edges_of)
        star = found[2] if marked else np.zeros(len(found[0]), bool)
        return pd.DataFrame({"a": found[0], "b": found[1], "star": star})

    crossed = unit.groupBy("bucket", "low", "high").applyInPandas(two_blocks, "a long, b long, star boolean")
    every = found.filter("bucket is null").select("a", "b", "star").unionByName(crossed)
    return every if marked else every.select("a", "b")


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``group`` and ``component_id`` (smallest ``doc_id`` reached by links) for every row.

    Repeated rows share their result. A row without ``doc_id`` links like others but lends no id:
    the component of such rows alone is NULL. An empty table gives an empty result.
    """
    prints = kept(fingerprints(docs, shingle), "fingerprints")
    classes = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = components(links(classes, distance)).toDF("node", "root")
    classes = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    classes = kept(classes, "fingerprint-roots")
    ids = classes.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "of")
    named = classes.join(ids, classes["root"] == ids["of"])
    named = kept(named.select(F.col("fp").alias("class"), F.col("root").alias("group"), "component_id"), "fingerprint-components")
    return prints.join(named, prints["fp"] == named["class"]).select("doc_id", "text_hash", "fp", "group", "component_id")


def representatives(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the one with the smallest ``doc_id``.

    Rows without ``doc_id`` come last, ties go to the smaller text hash, and of identical rows one stays.
    """
    return _firsts(docs, near_duplicates(docs, distance, shingle))


def _firsts(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The first row of ``docs`` of each ``group`` of ``named``."""
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")).alias("first")
    stay = kept(named.groupBy("group").agg(first).select("first.doc_id", "first.text_hash"), "representatives")
    stay = stay.toDF("stay_id", "stay_hash")
    digest = F.xxhash64("text")
    same = docs["doc_id"].cast("long").eqNullSafe(stay["stay_id"]) & (digest == stay["stay_hash"])
    rows = docs.join(stay, same, "left_semi")
    order = Window.partitionBy("doc_id", digest).orderBy(F.lit(1))
    (row,) = fresh(docs, "row")
    return rows.withColumn(row, F.row_number().over(order)).filter(F.col(row) == 1).drop(row)
