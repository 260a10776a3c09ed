"""Near duplicates at a Jaccard similarity of word shingles, by Golay keys of several fingerprints.

Texts are similar if the sets of their shingles (five words in a row, A-Z in lower case; a shorter
text is one shingle) have a Jaccard similarity J of ``similarity`` or more.

1. Fingerprints. A bit is the parity of the smallest of one hash of all shingles, so bits of two texts
   differ with probability (1 - J) / 2 each: 6.4 of 64 on average at J = 0.8, against 32 for texts
   without common shingles. A text has four fingerprints of 64 bits of their own hashes.
2. Candidates. Each fingerprint has the Golay keys of :mod:`simhash`. Texts that share a bucket and
   differ in at most ``REACH`` bits of that fingerprint meet. They are candidates if they differ in at most
   ``TOTAL`` bits of all four: that leaves out texts that meet by chance, whose number grows with the square of
   the corpus. Small groups of a bucket hand on all their pairs, large ones stars.
3. Verify. Every candidate's similarity is counted on the words of both texts, without hashes.
4. Stars again. A star's edge that is no candidate, or fails, may hide pairs of its leaves. Inside the
   components of stars with such an edge, all candidates whose texts are not linked yet are verified as well,
   block by block, without a row per pair.

One fingerprint misses about an eighth of the pairs at J = 0.8, four miss less than one of 1,000, and fewer
above. Texts with the same shingles are one row before keys are made. All tables written on the way go as the
function ends.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stratawork.operators.joins import broadcast_when_small

from .components import components
from .simhash import _firsts, bucket_links
from .storage import Rows, Scope, kept, small_batches, text_rows

SIMILARITY = 0.8
SHINGLE = 5
PRINTS = 4
#: Bits of one fingerprint in which texts that meet may differ: 1.7 standard deviations above the mean at J = 0.8.
REACH = 10
#: Bits of all fingerprints in which candidates may differ: six standard deviations above the mean at J = 0.8.
TOTAL = 54
#: Texts of a block; a task compares two blocks.
BLOCK = 256
# Odd multipliers and addends of the hashes of the bits.
_DRAW = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 64, (2, 64 * PRINTS), np.uint64, False)
MULTIPLIERS, ADDENDS = _DRAW[0] | np.uint64(1), _DRAW[1]


def shingles(text: str | None, size: int = SHINGLE) -> set[bytes]:
    """The text's shingles, words joined by one blank; none without words."""
    words = (text or "").encode().lower().split()
    if len(words) <= size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(s) for s in zip(*[words[k:] for k in range(size)])}


def similar(one: set[bytes], two: set[bytes], similarity: float = SIMILARITY) -> bool:
    """Whether the Jaccard similarity is reached; two empty sets are equal."""
    both = len(one & two)
    either = len(one) + len(two) - both
    return not either or both / either >= similarity


def prints(hashes: np.ndarray) -> list[int]:
    """The fingerprints (signed 64 bits) of the hashes of a text's shingles; 0 without any."""
    if not len(hashes):
        return [0] * PRINTS
    low = np.full(64 * PRINTS, (1 << 32) - 1, np.uint32)
    for at in range(0, len(hashes), 512):
        # the upper half of the product depends on all bits of the shingle's hash
        mixed = (hashes[at : at + 512, None] * MULTIPLIERS + ADDENDS) >> np.uint64(32)
        np.minimum(low, mixed.min(axis=0).astype(np.uint32), out=low)
    # the minimum's own bits are small numbers; mixed again, its parity is even
    low ^= low >> np.uint32(16)
    low *= np.uint32(0x85EBCA6B)
    low ^= low >> np.uint32(13)
    return np.packbits((low & np.uint32(1)).astype(bool), bitorder="little").view("<i8").tolist()


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash``, ``node`` (hash of the set of shingles) and the fingerprints ``f0``.. of every row."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, text_hash long, node long, " + ", ".join(f"f{k} long" for k in range(PRINTS))

    def run(batches):
        out = Rows(schema)
        for (doc, digest), text in text_rows(batches, ("doc_id", "text_hash")):
            hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles(text, size)], "<u8")
            hashes.sort()
            out.add(doc, digest, xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63), *prints(hashes))
            if out.full():
                yield out.batch()
        yield out.batch()

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, schema)


def verified(edges: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """``edges`` with ``ok``, whether the texts (``node``, ``text``) of ``a`` and ``b`` are similar.

    The text of ``b`` travels with each edge, the text of ``a``, the hub of a star, once.
    """
    one, two = texts.toDF("one", "text_a"), texts.toDF("two", "text_b")
    leaves = edges.join(two, edges["b"] == two["two"]).drop("two")
    pairs = leaves.join(one, leaves["a"] == one["one"])
    more = [c for c in edges.columns if c not in ("a", "b")]
    kinds = [("a", pa.int64()), ("b", pa.int64()), *[(c, pa.bool_()) for c in more], ("ok", pa.bool_())]
    schema = pa.schema(kinds)

    def run(batches):
        last, held = None, set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = []
                for node, left, right in zip(*[part.column(c).to_pylist() for c in ("a", "text_a", "text_b")]):
                    if node != last:
                        last, held = node, shingles(left, size)
                    found.append(similar(held, shingles(right, size), similarity))
                columns = [part.column(c) for c in ("a", "b", *more)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.bool_())], schema=schema)

    text = ", ".join(f"{c} {'long' if c in 'ab' else 'boolean'}" for c, _ in kinds)
    return kept(pairs.select("a", "b", *more, "text_a", "text_b").mapInArrow(run, text), "verified-pairs")


def _met(nodes: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` of nodes that meet, ``star`` if they stand for others, and whether they are candidates (``near``)."""
    found = []
    for k in range(PRINTS):
        # of nodes with one fingerprint the smallest stands for all
        same = kept(nodes.groupBy(F.col(f"f{k}").alias("fp")).agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")), "print-classes")
        # texts that are alike share many buckets; a pair is joined once, not once per bucket
        ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        edges = bucket_links(same, REACH, marked=True).select(*ends, "star").groupBy("a", "b").agg(F.max("star").alias("star"))
        edges = kept(edges, "print-links")
        left, right = same.toDF("fp_a", "x", "n_a"), same.toDF("fp_b", "y", "n_b")
        met = edges.join(left, edges["a"] == left["fp_a"]).join(right, edges["b"] == right["fp_b"])
        met = met.select("x", "y", (F.col("star") | (F.col("n_a") + F.col("n_b") > 2)).alias("star"))
        many = same.filter("n > 1")
        copies = nodes.join(many, nodes[f"f{k}"] == many["fp"]).select(F.col("hub").alias("x"), F.col("node").alias("y"), (F.col("n") > 2).alias("star"))
        found.append(met.unionByName(copies).filter("x <> y"))
    ends = F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    pairs = reduce(DataFrame.unionByName, found).select(*ends, "star").groupBy("a", "b").agg(F.max("star").alias("star"))
    names = [f"f{k}" for k in range(PRINTS)]
    one = nodes.select(F.col("node").alias("node_a"), *[F.col(f).alias(f"{f}_a") for f in names])
    two = nodes.select(F.col("node").alias("node_b"), *[F.col(f).alias(f"{f}_b") for f in names])
    both = pairs.join(one, pairs["a"] == one["node_a"]).join(two, pairs["b"] == two["node_b"])
    bits = sum((F.bit_count(F.col(f"{f}_a").bitwiseXOR(F.col(f"{f}_b"))) for f in names), F.lit(0))
    return kept(both.select("a", "b", "star", (bits <= TOTAL).alias("near")), "met")


def _block_links(nodes: DataFrame, similarity: float, size: int) -> DataFrame:
    """Edges ``a``, ``b`` between the roots that similar candidates connect inside each ``bad`` group of rows ``node``, ``root``, ``text``.

    Groups are cut into blocks by hash, and every two blocks meet in a task of their own, which compares
    fingerprints first and then the words of the candidates that no link connects yet. Two roots are connected once, so
    a group of any size makes rows in proportion to its nodes and blocks, never a row per pair.
    """
    names = [f"f{k}" for k in range(PRINTS)]
    blocks = nodes.groupBy("bad").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).withColumnRenamed("bad", "of")
    dealt = nodes.join(broadcast_when_small(blocks), F.col("bad") == F.col("of"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    ends = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    units = dealt.select("bad", *ends, "block", "node", "root", "text", *names)

    def compare(frame):
        import pandas as pd

        frame = frame.sort_values("node", ignore_index=True)
        prints, blocks = frame[names].to_numpy(np.int64), frame["block"].to_numpy()
        sets = [shingles(text, size) for text in frame["text"]]
        group = {root: k for k, root in enumerate(dict.fromkeys(frame["root"]))}
        of = np.array([group[root] for root in frame["root"]])
        left, right = [], []
        crossed = frame["low"].iat[0] != frame["high"].iat[0]
        for i in range(len(frame) - 1):
            bits = np.bitwise_count((prints[i] ^ prints[i + 1 :]).view(np.uint64))
            near = (bits.sum(axis=1) <= TOTAL) & (bits.min(axis=1) <= REACH)
            if crossed:
                near &= blocks[i + 1 :] != blocks[i]
            for j in (np.flatnonzero(near) + i + 1).tolist():
                if of[i] != of[j] and similar(sets[i], sets[j], similarity):
                    left.append(i)
                    right.append(j)
                    of[of == of[j]] = of[i]
        found = frame["root"].to_numpy()
        return pd.DataFrame({"a": found[left], "b": found[right]}, dtype="int64")

    return units.groupBy("bad", "low", "high").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``group`` for every row: texts are in one group if similar texts connect them.

    NULL texts and texts without words are similar to each other alone. Repeated rows share a group, a NULL
    ``doc_id`` stays NULL, an empty table gives an empty result; other columns are not read.
    """
    if not SIMILARITY <= similarity <= 1:
        raise ValueError("the fingerprints are laid out for similarities of 0.8 or more")
    with Scope(docs.sparkSession) as scope:
        return scope.hand_on(_groups(docs, similarity, size), "similar-groups")


def _groups(docs: DataFrame, similarity: float, size: int) -> DataFrame:
    rows = kept(sketches(docs, size), "sketches")
    names = [f"f{k}" for k in range(PRINTS)]
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")).alias("first")
    nodes = kept(rows.groupBy("node", *names).agg(first), "shingle-sets")
    met = _met(nodes.select("node", *names))
    own = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_hash"), F.col("text").alias("own_text"))

    def texts_of(edges):
        """One text of each node of the edges."""
        ends = edges.select(F.col("a").alias("end")).unionByName(edges.select(F.col("b").alias("end"))).distinct()
        at = nodes.join(ends, nodes["node"] == ends["end"], "left_semi").select("node", "first.doc_id", "first.text_hash")
        same = own["own_id"].eqNullSafe(at["doc_id"]) & (own["own_hash"] == at["text_hash"])
        return kept(own.join(at, same).groupBy("node").agg(F.first("own_text").alias("text")), "candidate-texts")

    def tested(edges):
        with Scope(docs.sparkSession) as scope:
            return scope.hand_on(verified(edges, texts_of(edges), similarity, size), "tested")

    near = tested(met.filter("near").select("a", "b", "star"))
    roots = kept(components(near.filter("ok").select("a", "b")), "linked-roots").toDF("known", "root")
    grouped = rows.join(roots, rows["node"] == roots["known"], "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("group"))
    failed = near.filter("star and not ok").select("a", "b").unionByName(met.filter("star and not near").select("a", "b"))
    if failed.isEmpty():
        return grouped
    reach = kept(components(met.filter("star").select("a", "b")), "star-components")
    bad = reach.join(failed, reach["node"] == failed["a"]).select(F.col("root").alias("bad")).distinct()
    suspect = kept(reach.join(bad, reach["root"] == bad["bad"]).select(F.col("node").alias("is"), "bad"), "suspects")
    rest = nodes.join(suspect, nodes["node"] == suspect["is"]).select("node", "bad", *names)
    rest = rest.join(roots, rest["node"] == roots["known"], "left").select("node", "bad", *names, F.coalesce("root", "node").alias("root"))
    texts = texts_of(suspect.select(F.col("is").alias("a"), F.col("is").alias("b"))).withColumnRenamed("node", "text_node")
    rest = rest.join(texts, rest["node"] == texts["text_node"]).drop("text_node")
    # roots are the smallest nodes of their groups, so only the few that meet are joined once more
    late = kept(_block_links(rest, similarity, size), "block-links")
    if late.isEmpty():
        return grouped
    merged = broadcast_when_small(kept(components(late), "late-roots").toDF("old", "new"))
    return grouped.join(merged, grouped["group"] == merged["old"], "left").select("doc_id", "text_hash", F.coalesce("new", "group").alias("group"))


def representatives(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, all their columns, without near duplicates, chosen as in :func:`simhash.representatives`."""
    return _firsts(docs, near_duplicates(docs, similarity, size))
