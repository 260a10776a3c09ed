"""Token alignment against the definition: every pair of byte ranges compared, whole-text library calls."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from stratawork.llm import align, queries
from stratawork.llm.pieces import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Plain words, and some more: 12 345!", "a  b\tc\n\nd ", " lead", "trail  ", "<|endoftext|> x<|endoftext|>", "<s> hi </s><unk>",
    "héllo ﬁ ① Ａ 日本語 テキスト", "é combining", "a▁b", "▁", "　wide", "👩‍👩‍👧 family", "x", " ", "\n", "\x00nul", "word " * 300,
    "zero​width", "ÀÉ ñandú straße", "it's we'll I'd", "", None, "nbsp here", "tab\tinside word\nline",
]


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def tokens(libraries, text):
    """(id, bytes) of both sides; nothing where bytes are lost."""
    if not text:
        return [], []
    a, b = libraries
    byte_of = {c: n for n, c in byte_alphabet().items()}
    found = a.encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in found]
    right = [
        (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)
    ]
    whole = b" " + text.encode()
    same = all(b"".join(x for _, x in side) == whole for side in (left, right))
    return (left, right) if same else ([], [])


def ranges(side):
    out, at = [], 0
    for i, data in side:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(libraries, texts):
    rows, counts = [], Counter()
    for text in texts:
        left, right = (ranges(x) for x in tokens(libraries, text))
        ends = sorted({e for *_, e in left} & {e for *_, e in right})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (left, right)))
            start = end
        links = [(i, j) for i, s, e in left for j, t, f in right if s < f and t < e]
        counts.update(set(links))
        rows.append((len(left), len(right), len(groups), links, ";".join(groups)))
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(top.get(i, 0), n)
    return [
        (a, b, g, len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), text)
        for a, b, g, links, text in rows
    ]


def test_ids_are_those_of_the_libraries(libraries):
    two = align.tokenizers(A, B)
    assert two.cuts
    for text in TEXTS:
        got = tuple(np.frombuffer(x, "<u4").tolist() for x in two.ids(text))
        assert got == tuple([i for i, _ in side] for side in tokens(libraries, text)), text


@given(st.text(st.sampled_from("ab é▁\t\n<|>'1日  .s"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text(libraries, text):
    got = tuple(np.frombuffer(x, "<u4").tolist() for x in align.tokenizers(A, B).ids(text))
    assert got == tuple([i for i, _ in side] for side in tokens(libraries, text))


@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=60), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_pieces_give_what_one_merge_gives(marks, work):
    """Every position may end a token of A, of B or of both; the last one ends both."""
    a = np.array([k + 1 for k, (x, _) in enumerate(marks) if x or k == len(marks) - 1], np.int64)
    b = np.array([k + 1 for k, (_, y) in enumerate(marks) if y or k == len(marks) - 1], np.int64)
    points = align.merge_path(a, b, work)
    for (i, j), (m, n) in zip(points, points[1:]):
        assert 0 <= m - i + n - j <= work + 1
        assert not set(a[i:m].tolist()) & set(b[n:].tolist()) and not set(b[j:n].tolist()) & set(a[m:].tolist())
    left, right, common_a, common_b = align.overlaps(a, b, work)
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])}
    assert len(left) == len(want) and set(zip(left.tolist(), right.tolist())) == want
    assert a[common_a].tolist() == b[common_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


@pytest.mark.parametrize(("work", "limit"), [(align.WORK, align.BROADCAST_BYTES), (7, 0)])
def test_documents(spark, libraries, work, limit):
    texts = [*TEXTS, TEXTS[0], TEXTS[6], "Plain words only"]
    docs = spark.createDataFrame([(k if k % 5 else None, t, 1, 2) for k, t in enumerate(texts)], "doc_id long, text string, row int, pairs int")
    rows = align.alignments(docs.repartition(3), A, B, work=work, broadcast_bytes=limit).collect()
    want = [(k if k % 5 else None, *r) for k, r in enumerate(brute(libraries, texts))]
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_over_its_whole_table(spark, sf, libraries):
    rows = {r.doc_id: r for r in queries.QUERIES["op13_alignment"](spark, sf).collect()}
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    short = [(d, t) for d, t in docs if len(t or "") <= 1500]
    assert set(rows) == {d for d, _ in docs} and len(short) > 50
    for doc, text in short:
        left, right = (ranges(x) for x in tokens(libraries, text))
        [(a, b, groups, links, *_, shown)] = brute(libraries, [text])
        row = rows[doc]
        assert (row.n_a, row.n_b, row.n_groups, row.n_links) == (a, b, groups, links)
        assert row.groups_sha256 == (hashlib.sha256(shown.encode()).hexdigest() if left else "")
        assert row.n_best <= links <= row.count_sum or not links
    # the counts need all documents: links of every text by a plain merge
    counts, found = Counter(), {}
    for doc, text in docs:
        left, right = (ranges(x) for x in tokens(libraries, text))
        links, i, j = [], 0, 0
        while i < len(left) and j < len(right):
            links.append((left[i][0], right[j][0]))
            end = min(left[i][2], right[j][2])
            i, j = i + (left[i][2] == end), j + (right[j][2] == end)
        found[doc] = links
        counts.update(set(links))
    top = Counter()
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    for doc, links in found.items():
        assert rows[doc].n_links == len(links) and rows[doc].count_sum == sum(counts[p] for p in links)
        assert rows[doc].n_best == sum(counts[p] == top[p[0]] for p in links)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.alignments(docs, A, B).collect() == []
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in align.alignments(only, A, B).collect()) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]
