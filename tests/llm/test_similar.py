"""Near duplicates at a similarity of 0.8 of five-word shingles against brute force over all pairs."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from test_graph_and_pairs import roots_of

from stratawork.llm import similar


def sets_of(texts):
    found = []
    for text in texts:
        words = (text or "").encode().lower().split()
        found.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return found


def brute(texts):
    sets = sets_of(texts)
    pairs = []
    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if 10 * len(one & two) >= 8 * len(one | two):
                pairs.append((i, j))
    return pairs, roots_of(range(len(texts)), pairs)


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randint(0, 10**9)}"
    return words


def test_near_copies(spark):
    rng = random.Random(3)
    texts = [None, "", "a b", "A  B", "a b c"]
    for k in range(60):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(40, 300))]
        texts.append(" ".join(base))
        texts += [" ".join(edited(rng, base, max(1, len(base) * share // 100))) for share in (1, 2, 3, 4, 8)]
    # a chain: each link is similar, its ends are not; and leaves of one failing hub
    chain = [f"c{k}" for k in range(200)]
    texts += [" ".join(chain[at : at + 150]) for at in range(0, 50, 6)]
    pairs, roots = brute(texts)
    docs = spark.createDataFrame([(k, t, "x", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sum(1 for i, j in pairs if (texts[i] or "").split() != (texts[j] or "").split()) > 100
    assert {r.doc_id for r in got} == {i for i in roots if roots[i] == i}


def test_pairs_behind_a_failed_star(spark):
    """The smallest node is a candidate of two others that it is not similar to, but they are to each other."""
    base = [f"v{k}" for k in range(204)]
    texts = [" ".join(base[:k]) for k in range(60, 204, 4)]
    pairs, roots = brute(texts)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.group for r in similar.near_duplicates(docs).collect()}
    assert len(pairs) < len(texts) * (len(texts) - 1) // 2
    assert {frozenset(d for d in got if got[d] == g) for g in got.values()} == {frozenset(i for i in roots if roots[i] == r) for r in roots.values()}


def test_only_verified_pairs_link(spark):
    """Many texts between 0.5 and 0.8: candidates of the fingerprints that must stay."""
    rng = random.Random(8)
    base = [f"u{k}" for k in range(120)]
    texts = [" ".join(edited(rng, base, 5)) for _ in range(30)]
    pairs, roots = brute(texts)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in similar.representatives(docs).collect()} == {i for i in roots if roots[i] == i}


def test_blocks_of_a_large_group(spark, monkeypatch):
    """A hub that is similar to none of many candidates, which are similar in pairs; blocks of four texts."""
    monkeypatch.setattr(similar, "BLOCK", 4)
    rng = random.Random(12)
    base = [f"t{k}" for k in range(150)]
    texts = []
    for _ in range(14):
        one = edited(rng, base, 4)
        texts += [" ".join(one), " ".join(edited(rng, one, 1))]
    pairs, roots = brute(texts)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.group for r in similar.near_duplicates(docs).collect()}
    assert len(set(roots.values())) > 5
    assert {frozenset(d for d in got if got[d] == g) for g in got.values()} == {frozenset(i for i in roots if roots[i] == r) for r in roots.values()}


def test_a_pair_is_joined_once(spark, monkeypatch):
    """Near copies share many buckets; each pair of fingerprints leaves them as one row."""
    tables = []

    def kept(df, label, write=similar.kept):
        df = write(df, label)
        if label == "print-links":
            tables.append([frozenset((r.a, r.b)) for r in df.collect()])
        return df

    monkeypatch.setattr(similar, "kept", kept)
    rng = random.Random(21)
    base = [f"s{k}" for k in range(200)]
    texts = [" ".join(edited(rng, base, 1)) for _ in range(40)]
    pairs, roots = brute(texts)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in similar.representatives(docs).collect()} == {i for i in roots if roots[i] == i}
    assert len(tables) == similar.PRINTS and all(tables)
    assert all(len(t) == len(set(t)) for t in tables)


def test_late_links_join_roots_alone(spark, monkeypatch):
    """What blocks find connects the roots known by then: the links found before are not walked through again."""
    graphs, met = [], similar._met

    def half_met(nodes):
        """A hub that all others fail, and every second pair of those that meet."""
        first = nodes.agg(F.min("node")).first()[0]
        star = nodes.filter(F.col("node") != first).select(F.lit(first).alias("a"), F.col("node").alias("b"), F.lit(True).alias("star"), F.lit(False).alias("near"))
        return met(nodes).filter(f"a <> {first} and pmod(a ^ b, 2) = 0").unionByName(star)

    monkeypatch.setattr(similar, "_met", half_met)
    monkeypatch.setattr(similar, "components", lambda edges, of=similar.components: graphs.append([(r.a, r.b) for r in edges.collect()]) or of(edges))
    monkeypatch.setattr(similar, "BLOCK", 4)
    rng = random.Random(12)
    base = [f"t{k}" for k in range(150)]
    texts = []
    for _ in range(14):
        one = edited(rng, base, 4)
        texts += [" ".join(edited(rng, one, k)) for k in (0, 1, 1)]
    pairs, roots = brute(texts)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.group for r in similar.near_duplicates(docs).collect()}
    assert {frozenset(d for d in got if got[d] == g) for g in got.values()} == {frozenset(i for i in roots if roots[i] == r) for r in roots.values()}
    linked, _, late = graphs
    nodes = {n for e in linked for n in e}
    known = roots_of(nodes, linked)
    assert linked and late and {known.get(n, n) for e in late for n in e} == {n for e in late for n in e}
