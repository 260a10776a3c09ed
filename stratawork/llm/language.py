"""Language identification by nearest centroids of TF-IDF character n-grams.

A text is the vector of its hashed n-grams (1 to 3 characters of lower-case words, all else a blank):
damped counts times inverse document frequency, scaled to length 1. Each language has several centroids, since its texts
fall into kinds. A text belongs to the language of the centroid with the highest cosine; texts
further from it than nearly all of that language's training texts are marked as rejected.

Document frequencies, centroids' last step and rejection limits come from all training rows; only
the clustering starts from a sample of ``SAMPLE`` rows per language, drawn by hash.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .storage import Rows, small_batches, text_rows

#: Hash buckets of the n-grams.
BUCKETS = 4096
LONGEST = 3
CENTROIDS = 4
#: Rows of a language that start its clustering.
SAMPLE = 400
#: Standard deviations below a language's mean cosine where texts are rejected.
REJECT = 4.0
#: Turns differences of cosines into a score.
SHARPNESS = 40.0
UNKNOWN = "und"
#: Characters that are counted in one go.
SLICE = 1 << 18
OTHER = re.compile(r"[\W\d_]+")


def gram_counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text."""
    total = np.zeros(BUCKETS, np.int64)
    text = OTHER.sub(" ", text.lower())
    for at in range(0, max(1, len(text)), SLICE):
        # n-grams that begin in this slice
        codes = np.frombuffer(text[at : at + SLICE + LONGEST - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        value = np.zeros(len(codes), np.uint32)
        for n in range(LONGEST):
            value = value[: len(codes) - n] * np.uint32(0x01000193) + codes[n:] + np.uint32(n + 1)
            mixed = (value ^ value >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
            total += np.bincount(mixed[:SLICE] >> np.uint32(20), minlength=BUCKETS)
    return total


def features(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length 1 (or 0 for texts without characters)."""
    weights = np.log1p(counts) * idf
    return (weights / np.maximum(np.linalg.norm(weights, axis=-1, keepdims=True), 1e-12)).astype(np.float32)


def cluster(rows: np.ndarray, many: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from far-apart starting rows."""
    centres = rows[:1]
    while len(centres) < min(many, len(rows)):
        centres = np.concatenate([centres, rows[[(rows @ centres.T).max(axis=1).argmin()]]])
    for _ in range(rounds):
        near = (rows @ centres.T).argmax(axis=1)
        sums = np.stack([rows[near == k].sum(axis=0) if (near == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


class Model:
    """Languages in order, centroids with the language of each, and rejection limits."""

    def __init__(self, idf, langs, centres, owner, limits):
        self.idf, self.langs, self.centres, self.owner, self.limits = idf, langs, centres, owner, limits

    def cosines(self, texts: list[str]) -> np.ndarray:
        """Best cosine per text and language."""
        rows = features(np.stack([gram_counts(t) for t in texts]), self.idf)
        found = rows @ self.centres.T
        return np.stack([found[:, self.owner == k].max(axis=1) for k in range(len(self.langs))], axis=1)


def fit(train: DataFrame) -> Model:
    """A model of rows ``doc_id``, ``text``, ``lang``; rows without text or language are left out.

    The number of languages must be small enough to send their centroids to every task.
    """
    train = train.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    spark = train.sparkSession
    small_batches(spark)
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    none = np.zeros((0, BUCKETS), np.float32)
    if not langs:
        return Model(np.ones(BUCKETS), [], none, np.zeros(0, int), np.zeros(0))

    def frequency(batches):
        total, out = np.zeros(BUCKETS, np.int64), Rows("bucket long, n long")
        for _, text in text_rows(batches, "doc_id"):
            total += gram_counts(text) > 0
        some = np.nonzero(total)[0]
        out.columns = [some.tolist(), total[some].tolist()]
        yield out.batch()

    met = train.mapInArrow(frequency, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    idf = np.full(BUCKETS, np.log(1 + sum(sizes.values())) + 1)
    for bucket, n in met:
        idf[bucket] = np.log((1 + sum(sizes.values())) / (1 + n)) + 1

    draw = F.pmod(F.xxhash64("doc_id", F.lit("start")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, SAMPLE / n)).otherwise(share)
    counted = "doc_id long, lang string, counts binary"

    def counts(batches):
        out = Rows(counted)
        for key, text in text_rows(batches, ("doc_id", "lang")):
            out.add(*key, gram_counts(text).tobytes(), size=8 * BUCKETS)
            if out.full():
                yield out.batch()
        yield out.batch()

    drawn = train.filter(draw < share).select(F.col("doc_id").cast("long"), "lang", "text")
    # rows of one size, however long the texts are; a language has about SAMPLE of them
    sample = drawn.mapInArrow(counts, counted)

    def start(frame):
        import pandas as pd

        ordered = frame.sort_values(["doc_id", "counts"])["counts"]
        rows = features(np.stack([np.frombuffer(c, np.int64) for c in ordered]), idf)
        return pd.DataFrame({"lang": frame["lang"].iat[0], "centre": [c.astype("f4").tobytes() for c in cluster(rows, CENTROIDS)]})

    found = sample.groupBy("lang").applyInPandas(start, "lang string, centre binary").collect()
    found = sorted((r["lang"], bytes(r["centre"])) for r in found)
    langs = sorted({lang for lang, _ in found})
    owner = np.array([langs.index(lang) for lang, _ in found])
    centres = np.stack([np.frombuffer(c, "f4") for _, c in found]) if found else none
    shared = spark.sparkContext.broadcast(Model(idf, langs, centres, owner, None))

    def refine(batches):
        """Sums per centroid over all rows, and cosine moments per language (bucket -1, -2, -3)."""
        model, out = shared.value, Rows("centre long, bucket long, value double")
        sums, moments = np.zeros((len(model.centres), BUCKETS)), np.zeros((len(model.langs), 3))
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = features(np.stack([gram_counts(t) for t in part.column("text").to_pylist()]), model.idf)
                kind = np.array([model.langs.index(x) if x in model.langs else -1 for x in part.column("lang").to_pylist()])
                cosine = np.where(model.owner[None, :] == kind[:, None], rows @ model.centres.T, -1.0)
                np.add.at(sums, cosine.argmax(axis=1)[kind >= 0], rows[kind >= 0])
                best = cosine.max(axis=1)
                for k in range(len(model.langs)):
                    own = best[kind == k].astype(float)
                    moments[k] += len(own), own.sum(), (own * own).sum()
        row, bucket = np.nonzero(sums)
        extra = [(k, -1 - m, moments[k, m]) for k in range(len(model.langs)) for m in range(3)]
        out.columns = [
            row.tolist() + [e[0] for e in extra],
            bucket.tolist() + [e[1] for e in extra],
            sums[row, bucket].tolist() + [float(e[2]) for e in extra],
        ]
        yield out.batch()

    schema = "centre long, bucket long, value double"
    # as whole numbers: sums of doubles would depend on the order in which tasks end
    exact = F.sum(F.round(F.col("value") * 2.0**20).cast("decimal(38,0)")).cast("double") / 2.0**20
    sums, moments = np.zeros_like(centres, float), np.zeros((len(langs), 3))
    for k, bucket, value in train.mapInArrow(refine, schema).groupBy("centre", "bucket").agg(exact).collect():
        if bucket < 0:
            moments[k, -1 - bucket] = value
        else:
            sums[k, bucket] = value
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres).astype(np.float32)
    n = np.maximum(moments[:, 0], 1)
    mean = moments[:, 1] / n
    limits = mean - REJECT * np.sqrt(np.maximum(moments[:, 2] / n - mean * mean, 0))
    return Model(idf, langs, centres, owner, limits)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1) and ``rejected`` of every whole text.

    NULL texts and texts without a letter are ``und`` with score 0, as is everything without a learned
    language; ties go to the first language in order. Only ``text`` decides.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, rejected boolean"

    def run(batches):
        model, out = shared.value, Rows(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                known = [i for i, t in enumerate(texts) if model.langs and t and any(map(str.isalpha, t))]
                found = {}
                if known:
                    best = model.cosines([texts[i] for i in known])
                    odds = np.exp(SHARPNESS * (best - best.max(axis=1, keepdims=True)))
                    for i, row, p in zip(known, best, odds / odds.sum(axis=1, keepdims=True)):
                        k = int(row.argmax())
                        found[i] = model.langs[k], float(p[k]), bool(row[k] < model.limits[k])
                for i, doc in enumerate(ids):
                    out.add(doc, *found.get(i, (UNKNOWN, 0.0, True)))
            if out.full():
                yield out.batch()
        yield out.batch()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def held_out(docs: DataFrame, parts: int, part: int):
    """Whether crc32 of ``doc_id`` as text leaves ``part`` by ``parts``; rows without an id are held out."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % parts == part, F.lit(True))
