"""Pieces, token files, packing and token counts against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratawork.llm import packing, queries, token_counts, token_files
from stratawork.llm.pieces import PieceEncoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, ids string, length string"
ODD = [
    (3, None, "x", "y"),
    (1, "", "x", "y"),
    (7, "two  blanks\n\nand lines ", None, None),
    (5, "word " * 3000, "x", "y"),
    (5, "word " * 3000, "x", "y"),
    (9, "same", "x", "y"),
    (None, "no id", "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


TOKENIZERS = {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}


def library(path, text):
    return TOKENIZERS[path].encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module", params=[BYTE, WORD])
def pair(request):
    return PieceEncoder(request.param), Tokenizer.from_file(request.param)


PARTS = ["a", "Bcd", "é", "ß", " ", " ", "\n", "  ", "'s", "'", ".", "!", "<|endoftext|>", "12", "́", "\t", "中", "-", "\x1c", " ", "İ", "Σ"]


def test_pieces_equal_the_library(pair):
    encoder, tokenizer = pair
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert encoder.ids(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


ENCODERS = {path: PieceEncoder(path) for path in (BYTE, WORD)}


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_of_any_text(text):
    for path in (BYTE, WORD):
        encoder = ENCODERS[path]
        assert encoder.ids(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()




@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_streams_come_back(codes):
    codes = np.array(codes, "<u4")
    control, data = token_files.encode_stream(codes)
    assert len(control) == -(-len(codes) // 4)
    assert (token_files.decode_stream(control, data, len(codes)) == codes).all()


def expected_files(docs):
    rows, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        ids = np.array([*library(BYTE, text), 0], "<u4")
        rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def test_token_files(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op4_token_files(spark, sf).collect()]
    assert sorted(got) == expected_files(docs)


def test_token_files_of_odd_rows(spark, odd, tmp_path):
    folder = token_files.write_token_files(odd, BYTE, 0, str(tmp_path / "files"))
    got = token_files.with_starts(token_files.read_token_files(spark, folder)).collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got), key=lambda r: r[1])
    assert got == expected_files([r[:2] for r in ODD])
    counts = [r["id"] for r in spark.read.parquet(f"{folder}/codes").orderBy("rank").collect()]
    words = [i for r in ODD for i in [*library(BYTE, r[1]), 0]]
    assert sorted(set(words), key=lambda i: (-words.count(i), i)) == counts


def test_token_files_of_nothing(spark, odd):
    folder = token_files.write_token_files(odd.limit(0), BYTE, 0)
    assert token_files.with_starts(token_files.read_token_files(spark, folder)).collect() == []


def check_packing(rows, texts, limit):
    want = []
    for doc, text in texts:
        ids = np.array([*library(WORD, text), 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), limit)):
            want.append((doc, piece, at, len(ids[at : at + limit]), zlib.crc32(ids[at : at + limit].tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= limit
    return len(places)


def test_packing(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op5_best_fit(spark, sf).collect()
    used = check_packing(rows, docs, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


@pytest.mark.parametrize("limit", [1, 7, 64])
def test_packing_of_odd_rows(spark, odd, limit):
    rows = packing.packed_documents(odd, WORD, limit).collect()
    check_packing(rows, [r[:2] for r in ODD], limit)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    assert packing.packed_documents(odd.limit(0), WORD, limit).collect() == []


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(deadline=None)
def test_sweep_is_best_fit_decreasing(lengths):
    limit, rooms = 40, []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(limit - length)
    counts = {n: lengths.count(n) for n in set(lengths)}
    used, placed = {}, dict.fromkeys(counts, 0)
    for length, first, pieces, start, per, offset in packing.sweep(counts, limit).tolist():
        placed[length] += pieces
        for i in range(pieces):
            used.setdefault(start + i // per, []).append((offset + i % per * length, length))
    assert placed == counts
    for spans in used.values():
        end = 0
        for at, length in sorted(spans):
            assert at == end
            end += length
        assert end <= limit
    assert sorted(limit - sum(n for _, n in s) for s in used.values()) == sorted(rooms)


def test_lengths_out_of_bounds_are_errors(spark):
    pieces = spark.createDataFrame([(1, 9)], "doc_id long, length long")
    with pytest.raises(ValueError, match="between 1 and 8"):
        packing.pack(pieces, 8, ["doc_id"])


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_token_counts_in_chunks(spark, path):
    rng = random.Random(3)
    words = ["alpha", "be", "c's", "<|endoftext|>", "\n", "1234", "éé", "...", "x" * 30]
    texts = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate((0, 1, 40, 200, 900, 901))]
    texts += [(10, "y" * 700), (11, "ab " * 30 + "z" * 900 + " cd" * 40), (12, " " * 500 + "a"), (12, " " * 500 + "a"), (None, "w " * 300), (14, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = token_counts.token_counts(docs, path, chunk=64, overlap=48).collect()
    want = [(k, len((t or "").encode()), len(library(path, t))) for k, t in texts]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_token_counts(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in queries.op6_token_counts(spark, sf).collect()}
    counts = {k: len(library(BYTE, t)) for k, t in docs}
    assert got == {(k, len(t.encode()), counts[k], counts[k] > 512) for k, t in docs}


def test_token_counts_of_nothing(spark, odd):
    assert token_counts.token_counts(odd.limit(0), BYTE).collect() == []
    assert token_counts.token_counts(odd.filter(F.col("doc_id") == 3), BYTE).collect()[0][1:] == (0, 0)


def test_columns_equal_the_library_and_look_a_word_up_once(pair):
    encoder, tokenizer = pair
    rng = random.Random(11)
    parts = [*PARTS, "\x01", "\x02", ".\n", ", ", "\xa0", "|", "\r\n", "x."]
    texts = [None, "", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000))]
    got = [ids for _, column in encoder.columns(pa.array(texts), 0) for ids in column.to_pylist()]
    assert got == [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for t in texts]
    texts = [f"start {a}zyx{b}yx{mark}{c}" for a in "bcd" for b in "uvw" for mark in ".,;!" for c in (" end", "\nEnd", "")]
    encoder.numbers.clear()
    list(encoder.columns(pa.array(texts)))
    # nine words, whatever marks and line breaks follow them
    assert len([w for w in encoder.numbers if "zyx" in w]) == 9


@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=9), max_size=9))
def test_streams_of_many_documents(docs):
    codes, counts = np.array([c for d in docs for c in d], "<u4"), [len(d) for d in docs]
    control, data, n_control, n_data = token_files.encode_streams(codes, counts)
    assert (token_files.decode_streams(control, data, counts) == codes).all()
    single = [token_files.encode_stream(np.array(d, "<u4")) for d in docs]
    assert [len(c) for c, _ in single] == list(n_control) and [len(d) for _, d in single] == list(n_data)
    assert b"".join(c for c, _ in single) == control.tobytes() and b"".join(d for _, d in single) == data.tobytes()
