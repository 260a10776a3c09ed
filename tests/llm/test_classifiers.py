"""The classifiers' results recomputed in plain Python from the fitted models, row by row."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from stratawork.llm import language, queries, toxicity


@pytest.fixture(scope="module")
def documents(sf):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf}/documents.parquet'").fetchall()


def grams(text):
    """Hashed n-grams of 1 to 3 characters, one by one."""
    shown = "".join(c if c.isalnum() and not c.isdecimal() else " " for c in text.lower())
    while "  " in shown:
        shown = shown.replace("  ", " ")
    found = Counter()
    for n in (1, 2, 3):
        for at in range(len(shown) - n + 1):
            value = 0
            for k in range(n):
                value = (value * 0x01000193 + ord(shown[at + k]) + k + 1) & 0xFFFFFFFF
            found[((value ^ value >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 20] += 1
    return found


def test_language_of_every_row(spark, sf, documents):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs.filter(~language.held_out(docs, 5, 0)))
    got = {r.doc_id: r for r in queries.QUERIES["op8_language_centroids"](spark, sf).collect()}
    counts = {d: grams(t or "") for d, t, _ in documents}
    train = [d for d, t, lang in documents if lang is not None and t is not None and zlib.crc32(str(d).encode()) % 5]
    # idf over all training rows
    met = Counter(b for d in train for b in counts[d])
    idf = [math.log((1 + len(train)) / (1 + met[b])) + 1 for b in range(language.BUCKETS)]
    assert np.allclose(idf, model.idf)
    assert model.langs == sorted({lang for d, _, lang in documents if d in set(train)})
    centres = [(model.langs[k], [float(x) for x in c]) for k, c in zip(model.owner, model.centres)]
    for doc, text, _ in documents:
        row = got[doc]
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
        if not text or not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        weights = {b: math.log1p(n) * idf[b] for b, n in counts[doc].items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        best = {}
        for lang, centre in centres:
            cosine = sum(w / norm * centre[b] for b, w in weights.items())
            best[lang] = max(best.get(lang, -1), cosine)
        top = max(best.values())
        winner = next(x for x in model.langs if best[x] == top)
        assert row.lang_pred == winner
        odds = sum(math.exp(language.SHARPNESS * (c - top)) for c in best.values())
        assert row.score == pytest.approx(1 / odds, abs=1e-3)
        limit = model.limits[model.langs.index(winner)]
        assert row.rejected == (top < limit) or abs(top - limit) < 1e-5


def test_centroids_are_means_of_their_rows(spark):
    """With one text per language all centroids of it are that text's vector."""
    rows = [(k, "the cat sat there" if k % 2 else "der hund lief fort", "en" if k % 2 else "de") for k in range(12)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for lang, text in (("en", "the cat sat there"), ("de", "der hund lief fort")):
        weights = {b: math.log1p(n) * model.idf[b] for b, n in grams(text).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        own = [c for k, c in zip(model.owner, model.centres) if model.langs[k] == lang]
        want = np.zeros(language.BUCKETS)
        want[list(weights)] = [w / norm for w in weights.values()]
        assert any(np.allclose(c, want, atol=1e-4) for c in own)


def test_a_language_of_long_texts_is_learned(spark):
    rows = [(k, "the cat and the dog went over the hill " * 3, "en") for k in range(20)]
    rows += [(100 + k, "кошка и собака идут через холм " * 5000, "ru") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.langs == ["en", "ru"]
    asked = spark.createDataFrame([(1, "собака и кошка"), (2, "a dog and a cat")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language.predict(asked, model).collect()} == {1: "ru", 2: "en"}


def convolved(net, words):
    """Score before the sigmoid, filter by filter and word by word, and the language the words speak for."""
    embedded = [[sum(float(net.embed[b][d]) for b in toxicity.forms(w)) for d in range(toxicity.DIM)] for w in words]
    padded = embedded + [[0.0] * toxicity.DIM] * (max(toxicity.WIDTHS) - len(embedded))
    pooled = []
    for width, kernel in zip(toxicity.WIDTHS, net.kernels):
        for f in range(toxicity.FILTERS):
            answers = (
                sum(padded[at + k][d] * float(kernel[k, d, f]) for k in range(width) for d in range(toxicity.DIM))
                for at in range(len(padded) - width + 1)
            )
            pooled.append(max(answers))
    z = sum(max(a + float(b), 0) * float(o) for a, b, o in zip(pooled, net.bias, net.out)) + float(net.out_bias)
    spoken = [sum(float(net.lang_table[toxicity.forms(w)[0]][k]) for w in words) for k in range(len(net.langs))]
    return z, spoken


def test_toxicity_of_every_row(spark, sf, documents):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    net = queries.toxicity_model(spark, docs, sf)
    got = {r.doc_id: r for r in queries.QUERIES["op10_toxicity_cnn"](spark, sf).collect()}
    assert len(got) == len(documents)
    shift = math.log(toxicity.CUT / (1 - toxicity.CUT))
    compared = 0
    for doc, text, _ in documents:
        row, words = got[doc], (text or "").split()
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
        z, spoken = convolved(net, words)
        ranked = sorted(spoken, reverse=True)
        if words and len(ranked) > 1 and ranked[0] - ranked[1] < 1e-2:
            continue  # two languages within rounding of each other
        cut = net.cuts[spoken.index(ranked[0]) if words else 0]
        compared += 1
        assert row.score == pytest.approx(1 / (1 + math.exp(-(z - cut + shift))), abs=2e-3)
        assert row.predicted == int(row.score >= toxicity.CUT)
    assert compared > 0.95 * len(documents)


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Long texts count as well, the words of each language over all rows, and shards of a few rows agree with reruns."""
    monkeypatch.setattr(toxicity, "SHARD", 50, raising=False)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "kappa"]

    def text(k):
        words = [plain[(k + i * i) % 6] for i in range(4000 if k % 4 == 0 else 30)]
        return " ".join(words + ["grobian"] * (k % 4 == 0))

    rows = [(k, text(k), "en" if k % 2 else "de") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    net = toxicity.fit(docs, labels)
    assert net is not None and net.langs == ["de", "en"]
    for at, lang in enumerate(net.langs):
        counts = np.full(toxicity.BUCKETS, 0.1)
        for word, n in Counter(w for _, t, own in rows if own == lang for w in t.split()).items():
            counts[toxicity.forms(word)[0]] += n
        counts[0] = 1
        assert np.allclose(net.lang_table[:, at], np.log(counts / counts.sum()), atol=1e-5)
    asked = spark.createDataFrame([(1, "alpha beta grobian"), (2, "alpha beta"), (3, "alpha " * 5000 + "grobian")], "doc_id long, text string")
    assert {r.doc_id: r.toxic_score >= toxicity.CUT for r in toxicity.score(asked, net).collect()} == {1: True, 2: False, 3: True}
    again = toxicity.fit(docs.repartition(7), labels)
    assert (again.flat() == net.flat()).all() and (again.cuts == net.cuts).all()


def test_threshold_of_counted_logits():
    rng = np.random.default_rng(2)
    logits = rng.normal(0, 2, 300)
    toxic = (logits + rng.normal(0, 1, 300) > 1).astype(int)
    bins = np.floor(logits * toxicity.STEPS).astype(int)
    places = np.unique(bins)
    cut = toxicity.threshold(places, *[np.array([(toxic[bins == b] == kind).sum() for b in places]) for kind in (0, 1)])

    def f1(cut):
        return 2 * toxic[logits >= cut].sum() / ((logits >= cut).sum() + toxic.sum())

    assert f1(cut) >= max(f1(c) for c in logits) - 1e-9
