"""Components, SimHash, top-k and the cover tree against brute force."""

import math
import random
import sys

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from stratawork.llm import cover_tree, queries, simhash, top_k
from stratawork.llm.components import components, star_edges


def roots_of(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(1, k) for k in range(200, 260)]
    loose = [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    pairs = [*chain, *star, *loose, (7, 7), (1, 200), (-5, 100)]
    rng.shuffle(pairs)
    edges = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    want = roots_of({n for p in pairs for n in p}, pairs)
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {n: r for n, r in want.items() if n != 7}
    assert components(edges.limit(0)).collect() == []


def test_components_make_no_step_over_stars(spark, monkeypatch):
    """Each table is written by as many tasks as there are partitions: none is made to see that nothing changes."""
    module, made = sys.modules["stratawork.llm.components"], []
    monkeypatch.setattr(module, "kept", lambda df, label, kept=module.kept: made.append(label) or kept(df, label))
    stars = [(1, k) for k in range(2, 40)] + [(k, 100) for k in (100, 101, 102)]
    got = {r.node: r.root for r in components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == {n: 1 if n < 40 else 100 for n in [*range(1, 40), 100, 101, 102]}
    assert made == ["edges", "stars"]
    made.clear()
    # two stars and an edge between leaves; the same edges both ways
    both = [(1, 2), (1, 3), (5, 6), (6, 3), (2, 1), (3, 6)]
    got = {r.node: r.root for r in components(spark.createDataFrame(both, "a long, b long")).collect()}
    assert got == dict.fromkeys([1, 2, 3, 5, 6], 1)
    assert made[-2:] == ["small-star", "stars"] and len(made) <= 10


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=30))
def test_stars_keep_components(pairs):
    low, other = star_edges(np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int), 13)
    assert roots_of(range(13), list(zip(low.tolist(), other.tolist()))) == roots_of(range(13), pairs)


TABLES = simhash.golay_tables()


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
@settings(max_examples=300)
def test_near_fingerprints_share_a_bucket(value, flips):
    other = value
    for bit in flips:
        other ^= 1 << bit
    one, two = (set(simhash.bucket_keys(np.array([v], np.uint64).view(np.int64), *TABLES)[1].tolist()) for v in (value, other))
    assert one & two


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_classes(docs):
    prints = [fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    return prints, roots_of(range(len(docs)), pairs)


def test_simhash(spark, sf):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    prints, roots = near_classes(docs)
    got = {tuple(r) for r in queries.op1_simhash_golay(spark, sf).collect()}
    assert got == {(docs[i][0], f"{prints[i]:016x}", docs[roots[i]][0]) for i in range(len(docs))}
    assert len(set(roots.values())) < len(docs)


def test_simhash_of_odd_rows(spark):
    base = "one two three four five six seven eight nine ten " * 4
    docs = [(4, None), (2, ""), (9, " \t\n"), (6, base), (3, base.upper()), (6, base), (None, base), (8, "a b"), (None, "q w e r t y"), (5, "x " * 70000)]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, fp string, bucket int")
    got = simhash.near_duplicates(table).collect()
    seen = sorted(((r.doc_id, r.component_id) for r in got), key=str)
    assert seen == sorted([(4, 2), (2, 2), (9, 2), (6, 3), (3, 3), (6, 3), (None, 3), (8, 8), (None, None), (5, 5)], key=str)
    stay = simhash.representatives(table).collect()
    assert sorted((r.doc_id for r in stay), key=str) == sorted([2, 3, 8, None, 5], key=str)
    assert stay[0].asDict().keys() == {"doc_id", "text", "fp", "bucket"}
    assert simhash.near_duplicates(table.limit(0)).collect() == []


@pytest.mark.parametrize("block", [3, 16, 2048])
def test_crowded_buckets(spark, block):
    rng = random.Random(block)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(150):
        value = base
        for bit in rng.sample(range(64), rng.randint(0, 6)):
            value ^= 1 << bit
        prints.add(value)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    prints = sorted(p - (p >> 63 << 64) for p in prints)
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(table, 4, block).collect()]
    near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) % 2**64).bit_count() <= 4]
    assert roots_of(prints, edges) == roots_of(prints, near)
    if block > len(prints):  # blocks of a few rows only serve to cross them; their stars overlap
        assert len(edges) < 100 * len(prints)


def test_distance_has_a_proof_up_to_four(spark):
    with pytest.raises(ValueError, match="up to 4"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 5)


def test_top_k(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    vectors = {r.vec_id: [math.floor(256 * x) for x in r.embedding] for r in rows}
    want = set()
    for q in vectors:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
            want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)}
    assert {tuple(r) for r in queries.op7_top_k(spark, sf).collect()} == want


def test_top_k_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, []), (8, [2.0]), (None, [5.0, 5.0]), (9, [-1.0, -1.0]), (9, [-1.0, -1.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in top_k.top_k_of_every(table, 50, 5).collect()]
    assert sorted(got) == [(0, 1, 1, 131072), (0, 2, 2, 131072), (0, 3, 9, -131072)]
    assert top_k.top_k_of_every(table.limit(0), 50).collect() == []
    huge = spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceed"):
        top_k.top_k_of_every(huge, 50).collect()


def brute_links(rows, threshold):
    def fine(r):
        return r[2] is not None and r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    degree, pairs = [0] * len(rows), []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if fine((0, a[1], a[2])) and fine((0, b[1], b[2])) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold:
                    degree[i] += 1
                    degree[j] += 1
                    pairs.append((i, j))
    roots, smallest = roots_of(range(len(rows)), pairs), {}
    for i, r in roots.items():
        if rows[i][0] is not None:
            smallest[r] = min(smallest.get(r, rows[i][0]), rows[i][0])
    return [(rows[i][0], degree[i], smallest.get(roots[i])) for i in range(len(rows))]


@pytest.mark.parametrize("cell", [6, 2048])
def test_cover_tree(spark, cell):
    rng = np.random.default_rng(cell)
    centres = rng.normal(size=(6, 8))
    rows = [(k, (centres[k % 6] + rng.normal(scale=0.25, size=8)).tolist(), f"l{k % 2}") for k in range(120)]
    rows += [(200 + k, centres[0].tolist(), "l0") for k in range(9)] + [(300 + k, (centres[1] * (k + 1)).tolist(), "l1") for k in range(9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {(r.vec_id, r.n_links, r.component_id) for r in cover_tree.linked(table, 0.93, cell).collect()}
    assert got == set(brute_links(rows, 0.93))


def test_cover_tree_of_given_vectors(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(v, e, None if label is None else str(label)) for v, e, label in rows]
    got = queries.op9_cover_tree(spark, sf).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == set(brute_links(rows, 0.93))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_cover_tree_of_odd_rows(spark):
    nan = float("nan")
    rows = [(5, [1.0, 0.0], "a"), (3, [2.0, 0.0], "a"), (4, [1.0, 0.0], "b"), (6, [1.0, 0.0], None), (7, [0.0, 0.0], "a"), (8, None, "a"), (9, [nan, 1.0], "a"), (10, [None, 1.0], "a"), (11, [1.0], "a"), (12, [], "a"), (None, [1.0, 0.1], "a"), (13, [1.0, 0.0], "b"), (13, [1.0, 0.0], "b")]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label string, n long, node string")
    got = cover_tree.linked(table, 0.93).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == sorted(brute_links(rows, 0.93), key=str)
    assert cover_tree.linked(table.limit(0)).collect() == []
