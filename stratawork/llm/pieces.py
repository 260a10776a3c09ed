"""Token ids of whole texts from a ``tokenizers`` file, with a bounded memory of words.

Byte-level and word-level BPE treat the words of a text apart from each other. A text is cut
at single spaces between two other characters; there a new word begins whatever stands around
it:

* byte-level pattern (``' ?letters| ?digits| ?others|blanks'``): a word takes the one space
  before it, and no alternative runs on over a space once it holds another character;
* word pattern: blanks are dropped, and neither NFC nor lower-casing joins across a space.

Whole columns are also cut around a line break between two characters that are not blank, which is
a word of its own or dropped, and between a letter or digit and the marks that a space or the end of
the text follows: letters, digits and marks never share a word. So fewer different words remain, and each
is looked up once for all texts of a slice.

Other files are used on whole texts. Special strings hold no space and end in no such marks, so no cut
falls into one.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .storage import binary_column

#: Words whose ids a worker remembers in each of two generations; the older one is forgotten as the
#: younger fills up, and words met again move to the younger.
MEMORY_WORDS = 300_000
#: Longer words are not remembered.
WORD_CHARS = 48

CUT = re.compile(r"(?<=\S) (?=\S)")
#: Marks that follow a word form one word of their own in both patterns.
MARKS = "!#$%&*+,-./:;=?@^_`|~()[]{}"
#: Letters that NFC leaves alone and that any version of Unicode calls letters.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
LATIN = re.compile(f"[{LETTERS}]+")
#: The further cuts of columns; the expressions are those of Arrow.
LINE_CUT = r"(\S)\n(\S)"
MARKS_CUT = rf"([{LETTERS}0-9])([{re.escape(MARKS)}]+)( |$)"
#: Stand before a word that no space precedes and for a line break; texts that hold them are not cut.
AFTER, LINE = "\x01", "\x02"
#: Bytes of the texts of a column whose words are looked up together.
SLICE_BYTES = 8 << 20


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves, the others from U+0100 on."""
    table, spare = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            table[byte] = chr(byte)
        else:
            table[byte] = chr(spare)
            spare += 1
    return table


class _Blank(Exception):
    """A part that is empty or has a blank at an end: the text needs the careful cut."""


class _Memory(dict):
    def __init__(self, compute):
        super().__init__()
        self.compute = compute
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if not word or word[0].isspace() or word[-1].isspace():
                raise _Blank
            ids = self.compute(word)
            if len(word) > WORD_CHARS:
                return ids
        if len(self) >= MEMORY_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class _Numbers(dict):
    """Numbers of words; the ids of word k are ``flat[ends[k] : ends[k + 1]]``. Number 0 has none and asks for the careful cut."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.flat, self.ends = compute, array("I"), array("q", [0, 0])

    def __missing__(self, word: str) -> int:
        try:
            self.flat.extend(self.compute(word))
        except _Blank:
            return 0
        self[word] = number = len(self.ends) - 1
        self.ends.append(len(self.flat))
        return number

    def full(self) -> bool:
        return len(self) > 4 * MEMORY_WORDS or len(self.flat) > WORD_CHARS * MEMORY_WORDS


class PieceEncoder:
    """The little-endian unsigned 32-bit ids of a text (``ids``) or a column of texts (``column``), without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = _kind(path)
        self.alphabet = byte_alphabet()
        self.lead = " " if self.kind == "byte" else ""
        self.glue = self.lead.translate(self.alphabet)
        self.split = self.tokenizer.model.tokenize
        self.packed = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.line = self._library("\n")
        self.memory = _Memory(self._word)
        self.after, self.lines = (AFTER, f" {LINE} {AFTER}") if self.kind == "byte" else ("", " ")
        self.numbers = _Numbers(self._part)

    def columns(self, texts: pa.Array, end_id: int | None = None):
        """Slice by slice: the first row's number, and the ids of every text (NULL: empty), each with ``end_id`` behind them."""
        rows = max(1, len(texts) * SLICE_BYTES // max(texts.nbytes, 1))
        for at in range(0, len(texts), rows):
            yield at, self._slice(texts.slice(at, rows).fill_null(""), end_id)

    def _slice(self, texts: pa.Array, end_id: int | None) -> pa.BinaryArray:
        ids, ends, odd = np.zeros(0, "<u4"), np.zeros(len(texts), np.int64), range(len(texts))
        if self.kind:
            ids, ends, odd = self._cut(texts)
        if len(odd):
            found = [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]
            for row in odd:
                found[row] = np.frombuffer(self.ids(texts[int(row)].as_py()), "<u4")
            ids, ends = np.concatenate(found), np.cumsum([len(x) for x in found])
        if end_id is not None:
            ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
        return binary_column(ids, ends)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where those of each end, and the texts that need the careful cut."""
        if self.numbers.full():
            self.numbers = _Numbers(self._part)
        wide = pa.large_string()
        texts = texts.cast(wide)
        shown = pc.if_else(pc.match_substring_regex(texts, f"[{AFTER}{LINE}]"), pa.scalar("", wide), texts)
        shown = pc.replace_substring_regex(shown, LINE_CUT, rf"\1{self.lines}\2")
        shown = pc.replace_substring_regex(shown, MARKS_CUT, rf"\1 {self.after}\2\3")
        words = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(self.after, wide), shown, pa.scalar("", wide)), " ")
        first = words.offsets.to_numpy()
        met = words.flatten().dictionary_encode()
        number = np.array(list(map(self.numbers.__getitem__, met.dictionary.to_numpy(zero_copy_only=False))), np.int64)
        flat, ends = np.array(self.numbers.flat, "<u4"), np.array(self.numbers.ends, np.int64)
        which = met.indices.to_numpy()
        lengths = (ends[number + 1] - ends[number])[which]
        stop = np.cumsum(lengths)
        at = np.repeat(ends[number][which] - stop + lengths, lengths)
        at += np.arange(len(at))
        ids = flat[at]
        odd = np.nonzero((number == 0)[which])[0]
        return ids, np.concatenate([[0], stop])[first[1:] - first[0]], np.unique(np.searchsorted(first - first[0], odd, "right") - 1)

    def _part(self, part: str) -> list[int] | memoryview:
        """Ids of a word of :meth:`_cut`."""
        glue, lead, word = self.glue, self.lead, part
        if part.startswith(AFTER):
            glue, lead, word = "", "", part[len(AFTER) :]
        if word.isalpha() and word.isascii():
            return [t.id for t in self.split(glue + (word.lower() if self.kind == "word" else word))]
        if part == LINE:
            return memoryview(self.line).cast("I")
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Blank
        return memoryview(self._plain(word, lead, glue)).cast("I")

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.kind is None:
            return self._library(text)
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace() or first[0].isspace():
                raise _Blank
            return self._library(first) + b"".join(map(self.memory.__getitem__, rest))
        except _Blank:
            first, *rest = CUT.split(text)
            return self._library(first) + b"".join([self.memory.get(w) or self._library(self.lead + w) for w in rest])

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        head, line, tail = word.partition("\n")
        if line and head and tail and not tail[0].isspace() and not head[-1].isspace():
            # one line break between two words: a word of its own, or dropped
            if self.kind == "word":
                return self.memory[head] + self.memory[tail]
            return self.memory[head] + self.line + self._plain(tail, "", "")
        return self._plain(word, self.lead, self.glue)

    def _plain(self, word: str, lead: str, glue: str) -> bytes:
        """Letters, perhaps with marks behind them, go straight to the model as one or two words."""
        letters = word
        if not word.isalpha():
            letters = word.rstrip(MARKS)
            if not letters.isalpha():
                return self._library(lead + word)
        shown = letters.lower() if self.kind == "word" else letters
        if not letters.isascii():
            if not LATIN.fullmatch(letters):
                return self._library(lead + word)
            shown = shown.encode().decode("latin-1").translate(self.alphabet)
        tokens = self.split(glue + shown)
        if letters is not word:
            tokens += self.split(word[len(letters) :])
        return b"".join([self.packed[t.id] for t in tokens])


def _kind(path: str) -> str | None:
    """``byte`` or ``word`` where the file's settings are those the cut is proven for."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    for token in spec.get("added_tokens") or []:
        if re.search(r"\s", token["content"]) or token["lstrip"] or token["rstrip"] or token["normalized"]:
            return None
        # a special string is never letters with marks behind them
        if token["content"].rstrip(MARKS).isalpha() or not token["content"].strip(MARKS):
            return None
        # nor does one end in letters or digits with marks behind them
        if re.search(rf"[{LETTERS}0-9][{re.escape(MARKS)}]+$", token["content"]):
            return None
    if spec["model"]["type"] != "BPE" or spec["model"].get("dropout"):
        return None
    normal, before = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if spec.get("post_processor"):
        return None
    if normal is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
        return "byte"
    steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
    parts = before.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in parts] == ["Split", "ByteLevel"]:
        split, level = parts
        if split["behavior"] == "Removed" and split["invert"] and not level["use_regex"] and not level["add_prefix_space"]:
            # Fixed value: the pattern whose words never hold a blank.
            words = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            return "word" if split["pattern"] == {"Regex": words} else None
    return None


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a file; it outlives a task, so its memory serves the next ones."""
    return PieceEncoder(path)
