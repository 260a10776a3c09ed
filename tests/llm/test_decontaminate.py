"""Decontamination against brute force: short items, repeats, odd texts, both ways of the join."""

import random
import re
from pathlib import Path

import pytest

from stratawork.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    """(doc, words, hit word numbers, items) of every row, window by window."""
    grams = {}
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - window + 1)) if w else ():
            grams.setdefault(tuple(w[s : s + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for gram, owners in grams.items():
            for s in range(len(w) - len(gram) + 1):
                if tuple(w[s : s + len(gram)]) == gram:
                    hit.update(range(s, s + len(gram)))
                    named |= owners
        out.append((doc, len(w), hit, sorted(str(i) for i in named if i is not None)))
    return out


def planted(seed=4):
    rng = random.Random(seed)
    vocabulary = ["the", "a", "Été", "é", "x1", "2", "of", "日本", "été", "É"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(some(rng.randint(4, 9)))) for k in range(9)]
    items += [(10, "One two!"), (11, "solo"), (12, ""), (13, None), (None, "no id here at all"), (2, "same id, other text of it"), (14, items[0][1].upper())]
    docs = []
    for k in range(60):
        parts = some(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            parts[rng.randint(0, len(parts)) :] = [*(items[rng.randint(0, 8)][1]).split(), *some(3)]
        docs.append((k, rng.choice([" ", ", ", "\n", "-", "  "]).join(parts)))
    docs += [(60, None), (61, ""), (62, "?!"), (None, "one, TWO"), (None, "one, TWO"), (63, "solo " * 40), (64, "NO ID. HERE; at all (one-two)"), (60, None)]
    return docs, items


def found(df):
    return sorted(((r.doc_id, r.n_words, [i for s in r.spans for i in range(s.start, s.stop)], r.items, r.n_hit) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("window", [1, 5])
def test_contamination_is_that_of_brute_force(spark, window, limit):
    docs, items = planted()
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window, limit
    )
    want = sorted(((d, n, sorted(hit), named, len(hit)) for d, n, hit, named in brute(docs, items, window)), key=str)
    assert found(got) == want


def test_cutting_and_dropping(spark):
    rows = [
        (1, "Intro: one-two, three. Outro!", "x"),
        (2, "clean text here", "y"),
        (3, None, None),
        (4, "One two three", "z"),
        (5, "One two three  four, FIVE ", "z"),
    ]
    # names that the operator uses inside
    names = ["row", "words", "found", "spans", "start", "gram"]
    docs = spark.createDataFrame([(*r, *[7] * len(names)) for r in rows], "doc_id long, text string, doc string, " + ", ".join(f"{n} int" for n in names))
    bench = spark.createDataFrame([("q", "one two three", 1), ("q", "four five", 2)], "item_id string, text string, hash int")
    cut = decontaminate.without_spans(docs, bench, 3)
    assert cut.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.doc, r.words) for r in cut.collect()) == [
        (1, "Intro. Outro!", "x", 7),
        (2, "clean text here", "y", 7),
        (3, None, None, 7),
        (4, "", "z", 7),
        (5, " ", "z", 7),
    ]
    stay = lambda share: sorted(r.doc_id for r in decontaminate.without_documents(docs, bench, 3, share).collect())
    assert stay(0.0) == [2, 3] and stay(0.6) == [1, 2, 3] and stay(1.0) == [1, 2, 3, 4, 5]


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame(x, s) for x, s in zip(planted(), ("doc_id long, text string", "item_id long, text string")))
    assert decontaminate.contamination(docs.limit(0), items).collect() == []
    none = decontaminate.contamination(docs, items.limit(0))
    assert none.count() == docs.count() and none.filter("n_hit > 0").isEmpty()
    assert decontaminate.without_spans(docs, items.limit(0)).count() == docs.count()


def test_no_python_in_the_plan():
    source = Path(decontaminate.__file__).read_text()
    assert not re.search(r"udf|InPandas|InArrow|\.rdd|pandas", source)


def test_longer_text_than_any_buffer(spark):
    text = "w " * 300_000 + "one two three four five six seven eight nine ten " + "v " * 100_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "zero one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    row = decontaminate.contamination(docs, bench, 10).first()
    assert (row.n_words, row.n_hit, [tuple(s) for s in row.spans], row["items"]) == (400_010, 10, [(300_000, 300_010)], ["5"])
