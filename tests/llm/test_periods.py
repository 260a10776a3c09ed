"""Runs against the definition: every period of every stretch, and the query against plain Python over a whole table."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stratawork.llm import periods, queries


def brute(words, min_length=6, min_exponent=4):
    """Maximal stretches of each period from the equality of words that far apart; smallest periods only."""
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                part = words[i : j + q]
                if not any(all(part[k] == part[k + p] for k in range(len(part) - p)) for p in range(1, q)):
                    found.append((i, j + q - i, q))
            i = j + 1 if j > i else i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def find(texts):
    return periods.find_runs([np.array(t, np.int64) for t in texts])


@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=5))
@settings(max_examples=400, deadline=None)
def test_runs_of_small_alphabets(texts):
    assert find(texts) == [brute(t) for t in texts]


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=6))
@settings(max_examples=400, deadline=None)
def test_runs_of_powers(parts):
    text = [x for root, times in parts for x in root * times]
    assert find([text, [], text[::-1]]) == [brute(text), [], brute(text[::-1])]


def test_all_periods_and_places():
    rng = random.Random(3)
    texts = []
    for q in range(1, 41):
        root = [rng.randint(0, 10**6) for _ in range(q)]
        length = max(6, 4 * q) + rng.randint(0, q)
        tail = (root * 6)[:length]
        texts.append([rng.randint(0, 10**6) for _ in range(rng.randint(0, 50))] + tail + [rng.randint(0, 10**6) for _ in range(rng.randint(0, 50))])
        texts.append(tail[: max(6, 4 * q) - 1])
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts += [fibonacci[-1], [0] * 500, [0, 1] * 300, [0] * 5, [0] * 6]
    assert find(texts) == [brute(t) for t in texts]


@given(st.lists(st.integers(0, 40), min_size=2, max_size=40, unique=True), st.data())
@settings(max_examples=200, deadline=None)
def test_wavelet_tree(values, data):
    dense = np.argsort(np.argsort(values))
    low = data.draw(st.integers(0, len(values) - 1))
    high = data.draw(st.integers(low + 1, len(values)))
    tree, part = periods.WaveletTree(dense), sorted(dense[low:high].tolist())
    one = lambda x: np.array([x], np.int64)
    for v in range(len(values)):
        assert tree.below(one(low), one(high), one(v))[0] == sum(p < v for p in part)
    assert [tree.smallest(one(low), one(high), one(k))[0] for k in range(len(part))] == part


def test_suffix_array():
    rng = random.Random(5)
    texts = [[rng.randint(0, 2) for _ in range(n)] for n in (30, 1, 50, 8)]
    symbols = np.concatenate([np.array(t) + 3 * k for k, t in enumerate(texts)])
    sizes = [len(t) for t in texts]
    ends = np.repeat(np.cumsum(sizes), sizes)
    suffixes, _ = periods.suffix_levels(symbols, ends)
    assert suffixes.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i : ends[i]].tolist())


def digest(text):
    """The columns of the query for the words of one text."""
    words = text.encode().split()
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *shown, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def with_tail(doc, text):
    words, h = (text or "").encode().split(), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not words:
        return text or ""
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n)).decode()


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_over_its_whole_table(spark, sf):
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_periodic_runs"](spark, sf).collect()}
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert rows == {d: digest(with_tail(d, t)) for d, t in docs}
    assert sum(r[0] > 0 for r in rows.values()) > len(docs) // 20


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    ids = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 10 == 0][:40]
    texts = [None, "", " \t\n", "a", "a " * 9, "Ab aB Ab aB", "x y x y", "a\x0bb\x0cc\x1fd " * 30, "é " * 400 + "z", "p q r " * 50 + "s"]
    rows = [(d, texts[k % len(texts)], 1) for k, d in enumerate([*ids, *range(30), None, None])]
    spark.createDataFrame(rows, "doc_id long, text string, runs int").write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_odd_rows(spark, odd):
    folder, rows = odd
    got = [(r.doc_id, *(r[c] for c in COLUMNS)) for r in queries.QUERIES["op11_periodic_runs"](spark, folder).collect()]
    assert sorted(got, key=str) == sorted(((d, *digest(with_tail(d, t))) for d, t, _ in rows), key=str)


def test_batches_and_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(str(rng.randint(0, 1)) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["u v w " * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = {r.doc_id: r for r in periods.periodic_runs(docs).collect()}
    for k, text in enumerate(texts[:-1]):
        assert [tuple(r) for r in rows[k].runs] == brute(text.split()), text
    last = rows[len(texts) - 1]
    assert [tuple(r) for r in last.runs] == [(0, 180_000, 3)] and last.text == "u v w" and last.n_words == 180_000
    monkeypatch.setattr(periods, "BATCH_WORDS", 1)
    assert [tuple(r) for r in periods.find_runs([np.zeros(7, np.int64)])[0]] == [(0, 7, 1)]


def test_empty_table_and_arguments(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periods.periodic_runs(docs).collect() == []
    with pytest.raises(ValueError):
        periods.periodic_runs(docs, min_exponent=3)
