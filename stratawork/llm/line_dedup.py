"""Removal of repeated runs of lines, found by winnowing over line hashes.

A line ends at a newline or behind a sentence mark with a blank after it. Lines are equal if their words
are, whatever blanks (also no-break and other Unicode ones) stand between them. A run is a row of whole lines;
it is a repeat if it holds ``min_words`` words or more and occurred before, in an earlier document or further
up in its own.

1. Winnow. A gram is the shortest run from a line with ``gram_words`` words. Each window, the
   shortest run from a line with ``min_words`` words, selects the smallest hash among its grams.
   Any repeat holds a whole window, and equal windows select equal grams: at least one
   fingerprint of a repeat occurs twice.
2. Join positions. Fingerprints are counted; only places whose fingerprint occurs again go on.
3. Extend both ways. From such a place the match grows over the windows around it: the shortest
   runs of ``min_words`` words that begin at a line (forwards) and that end at one (backwards). A
   line lies in a repeat exactly if one of these around it occurred before. Windows are
   compared by 128 bits of hash over all their lines.
4. Delete. A window's first place (by ``doc_id``, text hash, line) stays, lines of its later places go.

Each window is joined to its first place alone, so a passage in a third of all documents costs one row
per place, and no pairs of places are made.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from .storage import Scope, fresh, kept, small_batches

MIN_WORDS = 50
GRAM_WORDS = 20
# ASCII blanks, and the marks that end a sentence.
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
STOP = np.isin(np.arange(256), list(b".!?"))
# Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# UTF-8 of the blanks beyond ASCII, and bytes that such blanks or odd ASCII ones begin with.
WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
FOLDED = re.compile(rb"(?:[ \t\v\f\r]|" + WIDE.pattern + rb")+")
ODD = np.isin(np.arange(256), [9, 11, 12, 13, 0xC2, 0xE1, 0xE2, 0xE3])
KEY = ("doc_id", "text_hash")
#: Rows of a batch that are worked on before their results are handed on.
SLICE = 128


class Lines:
    """The lines of a UTF-8 text: where they start, their words, and hashes of runs of them.

    Blanks between two lines belong to the earlier one, blanks before the first word to the first line.
    A text without words has no lines.
    """

    def __init__(self, data):
        raw = np.frombuffer(data, np.uint8)
        blank = np.ones(len(raw) + 2, bool)
        blank[1:-1] = BLANK[raw]
        odd = ODD[raw].any()
        if odd:
            for m in WIDE.finditer(data):
                blank[m.start() + 1 : m.end() + 1] = True
        self.odd = odd or bool((blank[1:-2] & blank[2:-1]).any())
        turns = np.flatnonzero(blank[1:] != blank[:-1])
        begins, ends = turns[::2], turns[1::2]
        newlines = np.flatnonzero(raw == 10)
        broken = np.searchsorted(newlines, begins[1:]) > np.searchsorted(newlines, ends[:-1])
        new = np.ones(len(begins), bool)
        new[1:] = broken | STOP[raw[ends[:-1] - 1]]
        first = np.flatnonzero(new)
        self.n, self.size = len(first), len(raw)
        last = np.append(first[1:], len(begins)) - 1
        self.begins, self.ends = begins[first], ends[last] if self.n else ends
        self.before = np.concatenate([[0], np.cumsum(last[: self.n] - first + 1)])
        self.view = memoryview(data)

    def hashed(self) -> "Lines":
        """Prepares :meth:`run_hash`."""
        view, digest = self.view, xxhash.xxh3_128_digest
        parts = [view[a:b] for a, b in zip(self.begins.tolist(), self.ends.tolist())]
        if self.odd:
            parts = [FOLDED.sub(b" ", p) for p in parts]
        found = b"".join(map(digest, parts))
        hashes = np.frombuffer(found, ">u8").reshape(-1, 2).astype(np.uint64)
        self.sums, self.back = [], []
        for column, base in enumerate(BASES):
            power, back = np.full((2, self.n + 1), base, np.uint64)
            back[:] = pow(base, -1, 1 << 64)
            power[0] = back[0] = 1
            total = np.cumsum(hashes[:, column] * np.cumprod(power)[:-1])
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), total]))
            self.back.append(np.cumprod(back))
        return self

    def without(self, gone: np.ndarray) -> bytes:
        """The text without the lines numbered ``gone``."""
        starts = self.begins.copy()
        starts[0] = 0
        stops = np.append(starts[1:], self.size)
        stay = np.ones(self.n, bool)
        stay[gone] = False
        return b"".join([self.view[a:b] for a, b in zip(starts[stay].tolist(), stops[stay].tolist())])

    def run_hash(self, first: np.ndarray, last: np.ndarray, column: int) -> np.ndarray:
        """Hash of lines ``first`` to ``last``: sum of line hash times base^(line - first), mod 2^64, then mixed."""
        value = (self.sums[column][last + 1] - self.sums[column][first]) * self.back[column][first]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ value >> np.uint64(32)

    def forward(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) of the shortest run with ``words`` words from each line that has one."""
        last = np.searchsorted(self.before, self.before[:-1] + words) - 1
        first = np.nonzero(last < self.n)[0]
        return first, last[first]

    def backward(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) of the shortest run with ``words`` words up to each line that has one."""
        last = np.nonzero(self.before[1:] >= words)[0]
        return np.searchsorted(self.before, self.before[last + 1] - words, "right") - 1, last

    def selected(self, gram_words: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows' first lines, and the line and hash of the gram that each selects (the last of equal ones)."""
        first, last = self.forward(min_words)
        if not len(first):
            return first, first, np.zeros(0, np.uint64)
        start, end = self.forward(gram_words)
        value = self.run_hash(start, end, 0)
        # grams start at the lines 0.. without gaps; those that end inside the window
        many = np.searchsorted(end, last, "right") - first
        best, width = np.arange(len(start)), 1
        chosen = np.zeros(len(first), np.int64)
        left = first.copy()
        rest = many.copy()
        chosen[:] = first
        while True:
            odd = (rest // width) % 2 == 1
            offer = best[left[odd]]
            now = chosen[odd]
            better = value[offer] <= value[now]
            chosen[odd] = np.where(better, offer, now)
            left[odd] += width
            if width * 2 > many.max():
                break
            nearer = best[: len(best) - width]
            further = best[width:]
            best = np.where(value[further] <= value[nearer], further, nearer)
            width *= 2
        return first, chosen, value[chosen]


def _by_row(batches, work, names: tuple[str, ...], kinds: tuple):
    """Output batches of ``work(text buffer, other columns of the row)``: arrays of equal length, or None for no rows.

    The row's key stands before the named columns.
    """
    schema = pa.schema([(k, pa.int64()) for k in KEY] + list(zip(names, kinds)))
    for batch in batches:
        more = [c for c in batch.schema.names if c not in (*KEY, "text")]
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            texts, others = part.column("text"), [part.column(c) for c in more]
            rows, found = [], []
            for i in range(part.num_rows):
                if texts[i].is_valid and (result := work(texts[i].as_buffer(), *[c[i].as_py() for c in others])) is not None:
                    rows.append(i)
                    found.append(result)
            if rows:
                each = pa.array(np.repeat(rows, [len(f[0]) for f in found]))
                columns = [part.column(k).take(each) for k in KEY]
                columns += [pa.array(np.concatenate([f[c] for f in found]), kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")


def _same(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["key_id"]) & (left["text_hash"] == right["key_hash"])


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``gone``, the numbers of the lines of each text that lie in repeats.

    Texts without such lines have no row; identical rows are one. Other columns are not read.
    """
    if not 0 < gram_words <= min_words:
        raise ValueError("a gram must fit into the shortest repeat")
    small_batches(docs.sparkSession)
    with Scope(docs.sparkSession) as scope:
        return scope.hand_on(_gone(docs, min_words, gram_words), "gone-lines")


def _gone(docs: DataFrame, min_words: int, gram_words: int) -> DataFrame:

    def marks_of(data):
        if len(data) < 2 * min_words - 1:
            return None
        lines = Lines(data)
        if lines.before[-1] < min_words:
            return None
        _, at, value = lines.hashed().selected(gram_words, min_words)
        new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        return at[new], value[new].view(np.int64)

    def winnow(batches):
        return _by_row(batches, marks_of, ("line", "mark"), (pa.int32(), pa.int64()))

    keyed = _keyed(docs)
    marks = kept(keyed.mapInArrow(winnow, "doc_id long, text_hash long, line int, mark long"), "marks")
    often = kept(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("mark").alias("seen")), "repeated-marks")
    places = marks.join(often, marks["mark"] == often["seen"], "left_semi")
    places = places.groupBy(*KEY).agg(F.collect_list("line").alias("lines")).toDF("key_id", "key_hash", "lines")
    places = kept(places, "places")

    def windows_of(data, places):
        lines = Lines(data).hashed()
        first, at, _ = lines.selected(gram_words, min_words)
        hit = np.isin(at, places)
        begin, end = lines.forward(min_words)
        back, stop = lines.backward(min_words)
        # a run up to a line begins with the window of its first line
        again = np.isin(back, first[hit])
        code = np.unique(np.concatenate([begin[hit] << 32 | end[hit], back[again] << 32 | stop[again]]))
        runs = code >> 32, code & 0xFFFFFFFF
        return *runs, *[lines.run_hash(*runs, c).view(np.int64) for c in (0, 1)]

    def extend(batches):
        return _by_row(batches, windows_of, ("first", "last", "high", "low"), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))

    window_schema = "doc_id long, text_hash long, first int, last int, high long, low long"
    found = keyed.join(places, _same(keyed, places)).select(*KEY, "lines", "text")
    windows = kept(found.mapInArrow(extend, window_schema), "windows")
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash", "first")
    firsts = windows.groupBy("high", "low").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = kept(firsts.select(F.col("high").alias("h"), F.col("low").alias("l"), "place"), "first-places")
    late = windows.join(firsts, (windows["high"] == firsts["h"]) & (windows["low"] == firsts["l"])).filter(place != F.col("place"))
    spans = late.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))))
    return spans.select(*KEY, gone.alias("gone"))


def without_repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS, name: str = "n_removed"
) -> DataFrame:
    """All rows of ``docs`` with later repeats cut out of ``text``, and ``name``, the number of lines cut.

    Rows stay even if their whole text was a repeat (then it is empty). NULL and short texts have no
    repeats. Rows with equal ``doc_id`` and text count as one place and are cut alike. A NULL
    ``doc_id`` comes after all others. Other columns are passed on, but for one called ``name``, which is
    replaced.
    """
    key_id, key_hash, gone = fresh(docs, "key_id", "key_hash", "gone")
    lost = repeated_lines(docs, min_words, gram_words).toDF(key_id, key_hash, gone)
    digest = F.xxhash64("text")
    same = docs["doc_id"].cast("long").eqNullSafe(lost[key_id]) & (digest == lost[key_hash])
    rows = docs.join(lost, same, "left").drop(key_id, key_hash)
    fields = [f for f in docs.schema.fields if f.name != name]
    names = [f.name for f in fields]

    def cut(batches):
        for batch in batches:
            text, lines = batch.column("text"), batch.column(gone)
            hit = lines.is_valid()
            if pc.any(hit).as_py():
                at = np.flatnonzero(hit.to_numpy(zero_copy_only=False)).tolist()
                left = [Lines(text[i].as_buffer()).without(np.array(lines[i].as_py())).decode() for i in at]
                text = pc.replace_with_mask(text, hit, pa.array(left, text.type))
            removed = pc.fill_null(pc.list_value_length(lines), 0).cast(pa.int64())
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in names} | {"text": text, name: removed})

    shown = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    return rows.mapInArrow(cut, ", ".join([*shown, f"`{name}` long"]))
