"""Line dedup, mixing, classifiers and the pipeline against brute force, SQL and held-out rows."""

import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))

from harness import connect, difference  # noqa: E402
from test_graph_and_pairs import near_classes  # noqa: E402

from stratawork.llm import language, line_dedup, mixing, queries, toxicity  # noqa: E402
from stratawork.llm.line_dedup import Lines  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def lines_of(text):
    """(bytes from its start to the next line's, bytes without outer blanks, words) of each line."""
    data = text.encode()
    found = Lines(data)
    starts = [0, *found.begins.tolist()[1:]] if found.n else []
    ends = [*starts[1:], len(data)]
    parts = [data[a:b] for a, b in zip(starts, ends)]
    return [(p, p.strip(b" \t\n\r\v\f"), len(p.split())) for p in parts]


def without_repeats(docs, min_words):
    """Maximal matches of every line with every earlier place, by comparing all pairs of places."""
    lines = [lines_of(t or "") for _, t in docs]
    places = defaultdict(list)
    for d, rows in enumerate(lines):
        for k, (_, body, _) in enumerate(rows):
            places[body].append((d, k))
    gone = [set() for _ in docs]
    for group in places.values():
        for n, (d, k) in enumerate(group):
            for e, j in group[:n]:
                if k and j and lines[d][k - 1][1] == lines[e][j - 1][1]:
                    continue
                run = words = 0
                while k + run < len(lines[d]) and j + run < len(lines[e]) and lines[d][k + run][1] == lines[e][j + run][1]:
                    words += lines[d][k + run][2]
                    run += 1
                if words >= min_words:
                    gone[d].update(range(k, k + run))
    return [(b"".join(p for k, (p, *_) in enumerate(rows) if k not in gone[d]).decode(), len(gone[d])) for d, rows in enumerate(lines)]


@given(st.lists(st.sampled_from(["a b. ", "c\n", "d e f! ", "\n\n", "g? h", " ", "é ü. ", "x.y "]), max_size=12))
@settings(max_examples=200)
def test_lines_cover_the_text(parts):
    text = "".join(parts)
    rows = lines_of(text)
    assert b"".join(p for p, *_ in rows) == (text.encode() if text.split() else b"")
    assert sum(n for *_, n in rows) == len(text.split())
    assert all(b"\n" not in body for _, body, _ in rows)


@given(st.lists(st.integers(1, 9), min_size=1, max_size=30), st.integers(1, 12), st.integers(0, 12))
@settings(max_examples=150, deadline=None)
def test_windows_select_the_smallest_gram(sizes, gram, more):
    text = "\n".join(" ".join(f"w{k}{i}" for i in range(n)) for k, n in enumerate(sizes))
    lines = Lines(text.encode()).hashed()
    first, at, value = lines.selected(gram, gram + more)
    begin, end = lines.forward(gram + more)
    start, stop = lines.forward(gram)
    hashes = lines.run_hash(start, stop, 0)
    assert first.tolist() == begin.tolist()
    for window, (a, b) in enumerate(zip(begin, end)):
        inside = [k for k in range(len(start)) if start[k] >= a and stop[k] <= b]
        smallest = min(hashes[k] for k in inside)
        assert value[window] == smallest and at[window] == max(k for k in inside if hashes[k] == smallest)


@pytest.mark.parametrize("min_words, gram_words", [(10, 4), (10, 10), (25, 6)])
def test_line_dedup(spark, min_words, gram_words):
    rng = random.Random(min_words + gram_words)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) + rng.choice([".", "!", "\n", ".\n"]) for _ in range(40)]
    docs = []
    for k in range(60):
        rows = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        if k % 3 == 0:
            at = rng.randint(0, 30)
            rows[1:1] = pool[at : at + rng.randint(1, 9)]
        docs.append((k, " ".join(rows)))
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, gone string, line int")
    got = line_dedup.without_repeats(table, min_words, gram_words).collect()
    want = without_repeats(docs, min_words)
    assert sum(n for _, n in want) > 10
    assert sorted((r.doc_id, r.text, r.n_removed) for r in got) == [(k, t, n) for (k, _), (t, n) in zip(docs, want)]
    assert got[0].asDict().keys() == {"doc_id", "text", "gone", "line", "n_removed"}


def test_line_dedup_of_given_documents(spark, sf):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in queries.op2_line_winnowing(spark, sf).collect())
    assert got == [(k, t, n) for (k, _), (t, n) in zip(docs, without_repeats(docs, 50))]


def test_line_dedup_of_odd_rows(spark):
    long = "one two three four five six seven eight nine ten. " * 6
    docs = [(2, long), (1, None), (5, long), (5, long), (None, long + "tail"), (3, ""), (4, " \n "), (6, "z " * 90000 + ". " + long)]
    table = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOCUMENTS)
    got = line_dedup.without_repeats(table).collect()
    seen = {(r.doc_id, None if r.text is None else len(r.text), r.n_removed) for r in got}
    # the text repeats itself after 50 words: its sixth sentence is within a later repeat, too
    first = without_repeats([(2, long)], 50)[0]
    assert seen == {(2, len(first[0]), first[1]), (1, None, 0), (5, 0, 6), (None, 4, 6), (3, 0, 0), (4, 3, 0), (6, 180002, 6)}
    assert len(got) == len(docs)
    assert line_dedup.without_repeats(table.limit(0)).collect() == []
    with pytest.raises(ValueError, match="gram"):
        line_dedup.repeated_lines(table, 10, 11)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf, name):
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLES[name]) is None


def water(sizes, weights, share, most):
    """Targets by sharing the excess until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: float(weights[k % len(weights)]) for k, s in enumerate(names)}
    whole, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = whole - sum(most * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        more = {s for s in free if target[s] > most * sizes[s]}
        if not more:
            return target | {s: most * sizes[s] for s in capped}
        capped |= more


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randint(0, 40), None, rng.choice(["a", "b", "B", "é", None, "big", "big", "big"]), 0) for k in range(600)]
    rows += [(None, "x y", None, "a", 0), (7, None, None, "a", 0), (3, "w", None, "void", 0), (3, "w", None, "void", 0), (900, "", None, "zero", 0)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = mixing.mix(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = water(sizes, (5, 2, 1), 1.5, 2.0)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= int(rate) + 1 and r.copies <= 2
        taken[r.source] += r.size * r.copies
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(40, 0.02 * target)
    emitted = Counter((r.doc_id, r.text, r.source) for r in mixing.emitted(docs).collect())
    copies = {(r.doc_id, r.source, r.size): r.copies for r in got}
    for doc, text, _, source, _ in rows:
        many = sum(1 for r in rows if (r[0], r[1], r[3]) == (doc, text, source))
        assert emitted[doc, text, source] == many * copies[doc, source, len((text or "").split())]
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.emitted(docs.limit(0)).collect() == []


def test_languages(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op8_language_centroids(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in out) >= 0.97 * len(out)


def test_languages_of_odd_rows(spark):
    texts = {"en": "the cat and the dog went over the hill ", "de": "die katze und der hund gingen über den hügel "}
    rows = [(k, texts[x] * (k % 5 + 1), x, "s", 0) for k in range(40) for x in texts] + [(50, None, "en", "s", 0), (51, "the end", None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    model = language.fit(docs)
    assert model.langs == ["de", "en"]
    asked = [(1, None), (2, ""), (3, "12 ... !"), (4, "the cat and the dog"), (4, "the cat and the dog"), (None, "der hund und die katze"), (6, "die katze " * 60000)]
    table = spark.createDataFrame([(*a, 0) for a in asked], "doc_id long, text string, score int")
    got = sorted(((r.doc_id, r.lang_pred) for r in language.predict(table, model).collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de"), (6, "de")], key=str)
    none = language.fit(docs.filter("lang is null"))
    assert {r.lang_pred for r in language.predict(table, none).collect()} == {"und"}
    assert language.predict(table.limit(0), model).collect() == []


def test_grams_do_not_depend_on_slices(monkeypatch):
    text = "Some text, with 12 words; and MORE of them. " * 40
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "SLICE", 37)
    assert (language.gram_counts(text) == whole).all()


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_toxicity_cnn(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    out = [r for r in rows if r.held_out and toxic.get(r.doc_id) is not None]
    hits = sum(r.predicted and toxic[r.doc_id] for r in out)
    assert hits >= 0.7 * sum(toxic[r.doc_id] for r in out)
    assert sum(r.predicted == toxic[r.doc_id] for r in out) >= 0.93 * len(out)


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa"]

    def text(bad):
        found = [rng.choice(words) for _ in range(30)]
        return " ".join(found[:10] + ["grobian"] * bad + found[10:])

    rows = [(k, text(k % 4 == 0), "en" if k % 2 else None, "s", 0) for k in range(400)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    votes = [(k, int(k % 4 == 0)) for k in range(400)] + [(0, 1), (1, 1), (2, None), (None, 1), (3, 7)]
    labels = spark.createDataFrame(votes, "doc_id long, toxic int")
    net = toxicity.fit(docs, labels)
    asked = [(1, None), (2, ""), (3, "alpha beta"), (4, "Alpha GROBIAN! beta"), (4, "Alpha GROBIAN! beta"), (None, "grobian"), (6, "alpha " * 50000 + "grobian")]
    table = spark.createDataFrame([(*a, "x") for a in asked], "doc_id long, text string, toxic string")
    got = toxicity.score(table, net).collect()
    assert sorted(((r.doc_id, r.toxic_score >= 0.7) for r in got), key=str) == sorted([(1, False), (2, False), (3, False), (4, True), (4, True), (None, True), (6, True)], key=str)
    assert got[0].asDict().keys() == {"doc_id", "text", "toxic", "toxic_score"}
    assert toxicity.fit(docs, labels.filter("toxic = 0")) is None
    assert {r.toxic_score for r in toxicity.score(table, None).collect()} == {0.0}
    assert toxicity.score(table.limit(0), net).collect() == []


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "mix", "pack"]
    tables = [docs.cache()]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], sf).cache())
        if name != "pack":
            assert tables[-1].columns == docs.columns and dict(tables[-1].dtypes) == dict(docs.dtypes)
    rows = [sorted((tuple(r) for r in t.collect()), key=str) for t in tables]
    scores = {r.doc_id: r.toxic_score for r in toxicity.score(docs, queries.toxicity_model(spark, docs, sf)).collect()}
    assert rows[1] == [r for r in rows[0] if scores[r[0]] < 0.7] and len(rows[1]) < len(rows[0])
    by_id = sorted(rows[1])
    cut = without_repeats([r[:2] for r in by_id], 50)
    assert rows[2] == sorted(((r[0], t, r[2], r[3], len(t)) for r, (t, _) in zip(by_id, cut)), key=str)
    by_id = sorted(rows[2])
    _, roots = near_classes([r[:2] for r in by_id])
    assert rows[3] == sorted((r for i, r in enumerate(by_id) if roots[i] == i), key=str)
    copies = {r.doc_id: r.copies for r in mixing.mix(tables[3]).collect()}
    assert Counter(rows[4]) == Counter({r: copies[r[0]] for r in rows[3] if copies[r[0]]})
    pieces = Counter((r[0], r[1]) for r in rows[5])
    assert all(pieces[doc, 0] == copies[doc] for doc in copies if copies[doc])
    assert corpus_pipeline.run(spark, sf).count() == len(rows[5])


def test_pipeline_of_odd_rows(spark, sf):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "a", 0), (3, "x y z", None, "b", 5), (3, "x y z", None, "b", 5)], DOCUMENTS)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = spark.createDataFrame(stage(spark, table, sf).collect(), stage(spark, table, sf).schema)
        assert np.isin(["sequence_id", "offset"], table.columns).all()
