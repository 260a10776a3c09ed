"""Alignment of two tokenizers' tokens of the same texts, by merge-path partitioning.

Tokens are byte ranges, so each side of a text is the ascending list of its tokens' ends. The texts
of a batch follow one another; both sides end together at the end of each text. The merge of the
two lists is cut along diagonals: on diagonal *d* a binary search finds how many of the first *d*
ends come from A. Cuts at every ``WORK``-th diagonal give pieces of equal work that need nothing of each
other, however long a text is. Equal ends are never cut apart.

A piece emits one overlap for each of its distinct ends: the tokens of either side that are open
there. An end that both sides share closes a group; pieces report those, and numbering them over all
pieces stitches the groups that lie across a cut.

How many documents hold a pair of ids linked is counted by Spark over the distinct pairs of each
document, and joined back to them.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratawork.operators.joins import broadcast_when_small

from .pieces import CUT, PieceEncoder, _Blank, _Memory, byte_alphabet
from .storage import kept, small_batches, text_rows

#: Ends of both sides that one piece merges.
WORK = 65_536
#: Tokens of both sides, and documents, after which a task aligns what it has gathered.
BATCH_TOKENS, BATCH_DOCUMENTS = 1 << 18, 4096
#: Pair counts up to this measured size are broadcast.
BROADCAST_BYTES = 64 << 20
SPACE = "▁"


class _Lossy(Exception):
    """Some token's bytes are not those of the text."""


class TwoTokenizers:
    """Ids of a text in a byte-level file (A, behind a space) and a sentencepiece file (B, which adds it).

    Where neither tokenizer can join tokens over a single space between two other characters, texts are
    cut there and words are remembered. For A that is shown in :mod:`.pieces`. B must be BPE without any
    normalising, and have no piece with a space behind another character: then no merge spans a cut.
    """

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor

        self.a = PieceEncoder(byte_file)
        self.a.tokenizer.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_file)
        byte_of = {c: b for b, c in byte_alphabet().items()}
        vocabulary = self.a.tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.cuts = self.a.kind == "byte" and _plain_bpe(piece_file) and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.memory = _Memory(self._word)

    def ids(self, text: str | None) -> tuple[bytes, bytes]:
        """Little-endian 32-bit ids of both sides; nothing where a side's bytes are not the text's."""
        if not text:
            return b"", b""
        try:
            if not self.cuts:
                return self._checked(text)
            try:
                found = list(map(self.memory.__getitem__, text.split(" ")))
            except _Blank:
                found = list(map(self._part, CUT.split(text)))
            return b"".join([f[0] for f in found]), b"".join([f[1] for f in found])
        except _Lossy:
            try:
                return self._checked(text)
            except _Lossy:
                return b"", b""

    def _part(self, part: str) -> tuple[bytes, bytes]:
        try:
            return self.memory[part]
        except _Blank:
            return self._checked(part)

    def _word(self, word: str) -> tuple[bytes, bytes]:
        return self._checked(word, self.a._word(word))

    def _checked(self, text: str, a: bytes | None = None) -> tuple[bytes, bytes]:
        a = self.a._library(" " + text) if a is None else a
        b = array("I", self.b.encode(text)).tobytes()
        whole = b" " + text.encode()
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join([table[i] for i in memoryview(ids).cast("I")]) != whole:
                raise _Lossy
        return a, b


def _plain_bpe(path: str) -> bool:
    """Whether a sentencepiece file is BPE that takes texts as they are, behind one added space."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    trainer, normal = model.trainer_spec, model.normalizer_spec
    as_is = normal.name == "identity" and not normal.precompiled_charsmap and not normal.remove_extra_whitespaces
    own = any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces)
    spaces = normal.add_dummy_prefix and normal.escape_whitespaces and not trainer.treat_whitespace_as_suffix
    return trainer.model_type == trainer.BPE and as_is and spaces and not own


@lru_cache(maxsize=1)
def tokenizers(byte_file: str, piece_file: str) -> TwoTokenizers:
    """The worker's tokenizers; they outlive a task, so their memory serves the next ones."""
    return TwoTokenizers(byte_file, piece_file)


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> list[tuple[int, int]]:
    """Points (ends of A, ends of B) that cut the merge of two ascending lists into pieces of ``work`` ends.

    Of equal ends A's comes first in the merge, and a cut between the two moves behind B's.
    """
    diagonal = np.arange(work, len(a) + len(b), work)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while np.any(low < high):
        middle = (low + high) // 2
        more = (low < high) & (a[np.minimum(middle, len(a) - 1)] <= b[np.maximum(diagonal - middle - 1, 0)])
        low, high = np.where(more, middle + 1, low), np.where(more, high, np.minimum(high, middle))
    points = [(0, 0)]
    for i, j in zip(low.tolist(), (diagonal - low).tolist()):
        if i and j < len(b) and a[i - 1] == b[j]:
            j += 1
        points.append((i, j))
    return [*points, (len(a), len(b))]


def piece_overlaps(a: np.ndarray, b: np.ndarray, start: tuple[int, int], stop: tuple[int, int]):
    """Overlaps (tokens of A, tokens of B) and which ends of A and of B are common, of the piece between two cuts."""
    (i, j), (m, n) = start, stop
    ends_a, ends_b = a[i:m], b[j:n]
    in_b, in_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    common_a = np.append(ends_b, -1)[in_b] == ends_a
    common_b = np.append(ends_a, -1)[in_a] == ends_b
    left = np.concatenate([np.arange(i, m), i + in_a[~common_b]])
    right = np.concatenate([j + in_b, np.arange(j, n)[~common_b]])
    return left, right, common_a, common_b


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK):
    """As :func:`piece_overlaps` for whole lists, put together from the pieces."""
    points = merge_path(a, b, work)
    parts = [piece_overlaps(a, b, *ends) for ends in zip(points, points[1:])]
    return tuple(np.concatenate(x) for x in zip(*parts))


class _Decimal:
    """Ids as decimal text with one of two marks behind them, in fields of one width."""

    def __init__(self, ids: int, inner: str, last: str):
        self.table = np.array([f"{i}{mark}".encode() for mark in (inner, last) for i in range(ids)])
        self.ids = ids

    def fields(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.table[ids + self.ids * last]


def group_texts(a_ids, b_ids, common_a, common_b, stops, tables) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text; ``stops`` has the token counts of both sides up to its end."""
    last_a, last_b = np.flatnonzero(common_a), np.flatnonzero(common_b)
    group_a = np.cumsum(common_a) - common_a
    group_b = np.cumsum(common_b) - common_b
    fields = np.empty(len(a_ids) + len(b_ids), f"S{max(t.table.itemsize for t in tables)}")
    fields[np.arange(len(a_ids)) + np.concatenate([[0], last_b + 1])[group_a]] = tables[0].fields(a_ids, common_a)
    fields[np.arange(len(b_ids)) + (last_a + 1)[group_b]] = tables[1].fields(b_ids, common_b)
    texts, start = [], 0
    for stop in (stops[0] + stops[1]).tolist():
        texts.append(fields[start:stop].tobytes().replace(b"\0", b"")[:-1])
        start = stop
    return texts


def _aligned(docs, two: TwoTokenizers, tables, schema: pa.Schema, with_groups: bool, work: int) -> pa.RecordBatch:
    """The rows of :func:`_links` of some documents (key, ids of A, ids of B)."""
    a_ids, b_ids = (np.frombuffer(b"".join([d[side] for d in docs]), "<u4").astype(np.int64) for side in (1, 2))
    a_stop, b_stop = (np.cumsum([len(d[side]) // 4 for d in docs]) for side in (1, 2))
    left, right, common_a, common_b = overlaps(np.cumsum(two.a_length[a_ids]), np.cumsum(two.b_length[b_ids]), work)
    texts = group_texts(a_ids, b_ids, common_a, common_b, (a_stop, b_stop), tables)
    width = len(two.b_bytes)
    span = len(two.a_bytes) * width
    of = np.searchsorted(a_stop, left, "right")
    pairs, times = np.unique(of * span + a_ids[left] * width + b_ids[right], return_counts=True)
    offsets = np.searchsorted(pairs, np.arange(len(docs) + 1) * span).astype(np.int32)
    totals = np.concatenate([[0], np.cumsum(common_a)])[np.concatenate([[0], a_stop])]
    counts = [np.diff(np.concatenate([[0], a_stop])), np.diff(np.concatenate([[0], b_stop])), np.diff(totals)]
    shown = [t.decode() for t in texts] if with_groups else [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
    columns = [
        pa.array([d[0] for d in docs], pa.int64()),
        *[pa.array(c, pa.int64()) for c in counts],
        pa.array(np.bincount(of, minlength=len(docs)), pa.int64()),
        pa.array(shown, pa.string()),
        pa.ListArray.from_arrays(offsets, pa.array(pairs % span, pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
    ]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def _links(docs: DataFrame, byte_file: str, piece_file: str, with_groups: bool, work: int) -> DataFrame:
    """Per row its counts, groups, and distinct linked pairs of ids (``a * ids of B + b``) with their number."""
    small_batches(docs.sparkSession)
    groups = "groups" if with_groups else "groups_sha256"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64())]
        + [(groups, pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
    )

    def run(batches):
        two = tokenizers(byte_file, piece_file)
        tables = _Decimal(len(two.a_bytes), ",", "|"), _Decimal(len(two.b_bytes), ",", ";")
        held, tokens = [], 0
        for doc, text in text_rows(batches, "doc_id"):
            held.append((doc, *two.ids(text)))
            tokens += (len(held[-1][1]) + len(held[-1][2])) // 4
            if tokens >= BATCH_TOKENS or len(held) >= BATCH_DOCUMENTS:
                yield _aligned(held, two, tables, schema, with_groups, work)
                held, tokens = [], 0
        if held:
            yield _aligned(held, two, tables, schema, with_groups, work)

    text = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, {groups} string, pairs array<long>, times array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, text)


def alignments(
    docs: DataFrame,
    byte_file: str,
    piece_file: str,
    with_groups: bool = True,
    work: int = WORK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups`` for every row.

    ``groups`` shows the ids of each group as ``a1,a2|b1;a3|b2,b3``; without ``with_groups`` there is its
    ``groups_sha256`` instead ('' for no tokens). A pair of ids counts the rows that hold it linked;
    ``count_sum`` adds up the counts of a row's links, ``n_best`` are its links whose pair has the highest
    count of its A id, ties included.

    NULL and empty texts, and texts whose tokens' bytes are not the text behind one space on both
    sides, have no tokens: zeros. Repeated rows count each; a NULL ``doc_id`` stays NULL; an empty table
    gives an empty result; other columns are neither read nor returned.
    """
    rows = _links(docs, byte_file, piece_file, with_groups, work).withColumn("row", F.monotonically_increasing_id())
    rows = kept(rows, "align-links")
    width = _ids_of_b(piece_file)
    each = rows.select("row", F.inline(F.arrays_zip("pairs", "times")))
    counts = kept(each.groupBy(F.col("pairs").alias("pair")).agg(F.count(F.lit(1)).alias("count")), "align-counts")
    counts = counts.withColumn("a", F.floor(F.col("pair") / width).cast("long"))
    tops = counts.groupBy("a").agg(F.max("count").alias("top")).withColumnRenamed("a", "of")
    counts = kept(
        counts.join(tops, F.col("a") == F.col("of")).select("pair", "count", (F.col("count") == F.col("top")).alias("best")),
        "align-tops",
    )
    met = each.join(broadcast_when_small(counts, broadcast_bytes), F.col("pairs") == F.col("pair"))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("count") * F.col("times")).alias("count_sum")
    )
    joined = rows.drop("pairs", "times").join(sums.withColumnRenamed("row", "sum_row"), F.col("row") == F.col("sum_row"), "left")
    none = F.lit(0).cast("long")
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best")]
    return joined.select(*shown, F.coalesce("count_sum", none).alias("count_sum"), "groups" if with_groups else "groups_sha256")


def _ids_of_b(piece_file: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=piece_file).get_piece_size()
