"""Token counts of whole texts; huge texts are counted in overlapping chunks that many tasks share.

A chunk starts anywhere, so its first tokens may differ from those of the whole text. The words
(pre-tokens) of both patterns known to :mod:`.pieces` are found by one scan from left to right
that looks at most one character ahead. Hence a word start that two overlapping chunks agree on
is one of the whole text, as long as it lies a margin before the earlier chunk's end: up to it
the earlier chunk is right, and from it the later one. Chunks are joined at the first such
place; the tokens of the earlier chunk behind it and of the later one before it do not count.

Where two neighbours agree nowhere (a word longer than the overlap), the document goes into a
further round with chunk and overlap four times as long, at last as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .pieces import encoder
from .storage import Rows, kept, small_batches, text_rows

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
#: Word starts this close to a chunk's end may still move: one character ahead, or a special string.
MARGIN_CHARS = 32


def token_counts(
    docs: DataFrame, tokenizer: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row of ``docs``.

    NULL and empty texts count 0; repeated rows are counted each; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    huge = F.length("text") > 2 * chunk
    schema = "doc_id long, n_bytes long, n_tokens long"

    def short(batches):
        encode, out = encoder(tokenizer), Rows(schema)
        for doc, text in text_rows(batches, "doc_id"):
            out.add(doc, len(text.encode()), len(encode.ids(text)) // 4)
            if out.full():
                yield out.batch()
        yield out.batch()

    plain = rows.filter(~huge).mapInArrow(short, schema)
    long = rows.filter(huge).withColumn("text_hash", F.xxhash64("text"))
    counts = kept(_in_chunks(long, tokenizer, chunk, overlap), "huge-counts")
    ids = long.select("doc_id", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"))
    same = ids["doc_id"].eqNullSafe(counts["doc_id"]) & (ids["text_hash"] == counts["text_hash"])
    return plain.unionByName(ids.join(counts, same).select(ids["doc_id"], "n_bytes", "n_tokens"))


def _in_chunks(long: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """``n_tokens`` by (doc_id, text_hash) of texts; rounds go on until every pair of chunks is joined."""
    done, pending = None, long
    while True:
        total = kept(_one_round(pending, tokenizer, chunk, overlap), "chunk-counts")
        good = total.filter("joined").select("doc_id", "text_hash", "n_tokens")
        done = good if done is None else done.unionByName(good)
        failed = total.filter("not joined").select("doc_id", "text_hash")
        if failed.isEmpty():
            return done
        same = long["doc_id"].eqNullSafe(failed["doc_id"]) & (long["text_hash"] == failed["text_hash"])
        pending = long.join(failed, same, "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap


def _one_round(long: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of documents, and whether all their chunks could be joined."""

    def cut(batches):
        out = Rows("doc_id long, text_hash long, chunk int, last boolean, text string")
        for batch in batches:
            for doc, digest, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")]):
                n = max(1, -(-(len(text) - overlap) // chunk))
                for k in range(n):
                    part = text[k * chunk : (k + 1) * chunk + overlap] if k < n - 1 else text[k * chunk :]
                    out.add(doc, digest, k, k == n - 1, part, size=len(part) + 32)
                    if out.full():
                        yield out.batch()
        yield out.batch()

    key = ["doc_id", "text_hash", "chunk"]
    parts = long.select("doc_id", "text_hash", "text").mapInArrow(cut, "doc_id long, text_hash long, chunk int, last boolean, text string")
    # identical rows are counted once here and joined to all of them later
    parts = parts.repartition(*key).dropDuplicates(key)
    schema = "doc_id long, text_hash long, chunk int, last boolean, n int, heads array<struct<at:int,before:int>>, tails array<struct<at:int,before:int>>"

    def count(batches):
        library, out = encoder(tokenizer).tokenizer, Rows(schema)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "last", "text")]
            for doc, digest, k, last, text in zip(*columns):
                found = library.encode(text, add_special_tokens=False)
                words, spans = found.word_ids, found.offsets
                starts = [
                    {"at": k * chunk + spans[i][0], "before": i}
                    for i in range(len(words))
                    if i == 0 or words[i] != words[i - 1] or words[i] is None
                ]
                low = k * chunk + overlap
                high = (k + 1) * chunk
                heads = [s for s in starts if s["at"] < low] if k else []
                tails = [] if last else [s for s in starts if high <= s["at"] <= high + overlap - MARGIN_CHARS]
                out.add(doc, digest, k, last, len(words), heads, tails, size=64 + 24 * (len(heads) + len(tails)))
                if out.full():
                    yield out.batch()
        yield out.batch()

    seen = kept(parts.select(*key, "last", "text").mapInArrow(count, schema), "chunks")
    ident = ["doc_id", "text_hash"]
    tails = seen.select(*ident, "chunk", F.col("n").alias("n_left"), F.inline("tails")).withColumnRenamed("before", "left")
    heads = seen.select(*ident, (F.col("chunk") - 1).alias("chunk"), F.inline("heads")).withColumnRenamed("before", "right")
    heads = heads.toDF("h_doc", "h_hash", "h_chunk", "h_at", "right")
    same = (
        tails["doc_id"].eqNullSafe(heads["h_doc"])
        & (tails["text_hash"] == heads["h_hash"])
        & (tails["chunk"] == heads["h_chunk"])
        & (tails["at"] == heads["h_at"])
    )
    seams = (
        tails.join(heads, same)
        .groupBy(*ident, "chunk")
        .agg(F.min_by(F.col("n_left") - F.col("left") + F.col("right"), "at").alias("extra"))
        .groupBy(*ident)
        .agg(F.sum("extra").alias("extra"), F.count(F.lit(1)).alias("seams"))
        .toDF("s_doc", "s_hash", "extra", "seams")
    )
    totals = seen.groupBy(*ident).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("chunks"))
    met = totals["doc_id"].eqNullSafe(seams["s_doc"]) & (totals["text_hash"] == seams["s_hash"])
    return totals.join(seams, met, "left").select(
        *ident,
        (F.col("n") - F.coalesce("extra", F.lit(0))).cast("long").alias("n_tokens"),
        (F.col("chunks") - 1 == F.coalesce("seams", F.lit(0))).alias("joined"),
    )
