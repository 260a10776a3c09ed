"""Benchmark decontamination by word n-grams, in DataFrame functions only.

Texts become words: runs of ASCII letters (A-Z in lower case), digits and all characters beyond
ASCII. The windows of a benchmark item are its runs of ``window`` words; an item of fewer words
is one window. Equal windows are one row, known by a hash and verified word by word.

* The windows are broadcast where their measured size allows it. Every position of a document is
  then looked up and verified in one pass over its words, and only hits travel.
* A larger benchmark is joined by hash: positions and windows are shuffled, and what meets is
  verified against the document's words afterwards.

A window carries the digest of the set of items it stands in, not the items: documents that hold
the same sets share one list of items, so a passage in a third of all documents and in many items
is listed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratawork.operators.joins import broadcast_when_small, measured_bytes

from .storage import kept

#: Windows up to this measured size are broadcast.
BROADCAST_BYTES = 64 << 20
#: Characters between words, in texts with and without capitals.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text; NULL has none."""
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, CAPITALS, CAPITALS.lower()))
    return F.coalesce(F.array_remove(F.split(lowered, BETWEEN), ""), F.array().cast("array<string>"))


def staged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (a number of its own for each row), ``doc`` (the columns ``keep``), ``words`` and ``n_words``, written once.

    The columns of ``docs`` stay inside ``doc``, so their names meet no other.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), doc, words(F.col("text")).alias("words"))
    return kept(rows.withColumn("n_words", F.size("words").cast("long")), "decontaminate-words")


def windows(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(``hash``, ``gram``, ``item_set`` of every distinct window; ``item_set`` and its sorted ``items``)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1))))
    grams = items.select("item", "w", start.alias("start")).select("item", F.slice("w", F.col("start"), window).alias("gram"))
    # sets of items have a digest of their own, as many windows share one
    found = grams.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = found.select(F.xxhash64("gram").alias("hash"), "gram", F.md5(F.to_json("items").cast("binary")).alias("item_set"), "items")
    found = kept(found, "decontaminate-windows")
    sets = kept(found.groupBy("item_set").agg(F.first("items").alias("items")), "decontaminate-sets")
    return found.drop("items"), sets


def hits(rows: DataFrame, grams: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``row``, ``start``, ``stop`` (word numbers) and ``item_set`` of every occurrence of a window in ``rows``."""
    # at most as many lengths as a window has words
    lengths = [r[0] for r in grams.select(F.size("gram").alias("n")).distinct().collect()]
    if not lengths:
        return rows.sparkSession.createDataFrame([], "row long, start int, stop int, item_set string")
    places = rows.filter(F.size("words") >= min(lengths)).select("row", "words", F.posexplode("words").alias("start", "word"))
    places = places.select("row", "words", "start", F.explode(F.array(*map(F.lit, sorted(lengths)))).alias("n"))
    places = places.filter(F.col("start") + F.col("n") <= F.size("words"))
    here = F.slice("words", F.col("start") + 1, F.col("n"))
    places = places.withColumn("at_hash", F.xxhash64(here))
    if measured_bytes(grams) <= broadcast_bytes:
        # between(): the words verify the match without becoming a part of the join's key
        met = places.join(F.broadcast(grams), (F.col("at_hash") == F.col("hash")) & F.col("gram").between(here, here))
    else:
        near = places.drop("words", "n").join(grams, F.col("at_hash") == F.col("hash"))
        near = near.groupBy("row").agg(F.collect_list(F.struct("start", "gram", "item_set")).alias("found"))
        near = near.withColumnRenamed("row", "near_row")
        joined = rows.select("row", "words").join(broadcast_when_small(near), F.col("row") == F.col("near_row"))
        same = F.filter("found", lambda f: F.slice("words", f["start"] + 1, F.size(f["gram"])) == f["gram"])
        met = joined.select("row", F.inline(same))
    return met.select("row", "start", (F.col("start") + F.size("gram")).alias("stop"), "item_set")


def spans(found: DataFrame) -> DataFrame:
    """Occurrences of each row merged: ``row``, ``n_hit``, ``spans`` (from, to) in order, ``item_sets``."""
    order = Window.partitionBy("row").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("opens", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
    marked = marked.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = marked.groupBy("row", "span").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.collect_set("item_set").alias("item_sets")
    )
    return merged.groupBy("row").agg(
        F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_sets")))).alias("item_sets"),
    )


def items_of(found: DataFrame, sets: DataFrame) -> DataFrame:
    """``of`` (every distinct list of item sets in ``found``) and its sorted ``items``."""
    lists = found.select("item_sets").distinct()
    each = lists.select(F.col("item_sets").alias("of"), F.explode("item_sets").alias("one"))
    named = each.join(broadcast_when_small(sets), F.col("one") == F.col("item_set"))
    listed = named.groupBy("of").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return listed.select("of", F.array_sort("items").alias("items"))


def _found(rows: DataFrame, benchmark: DataFrame, window: int, broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    if window < 1:
        raise ValueError("a window has one word or more")
    grams, sets = windows(benchmark, window)
    return kept(spans(hits(rows, grams, broadcast_bytes)), "decontaminate-spans"), sets


def _beside(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found.withColumnRenamed("row", "found_row"), F.col("row") == F.col("found_row"), "left").drop("found_row")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``spans`` and ``items`` for every row of ``docs``.

    ``spans`` are the merged ranges ``start`` to ``stop`` (word numbers from 0, ``stop`` not
    included) that windows of ``benchmark`` cover, ``items`` the item ids as strings in their order.

    A NULL or empty text has no words; a NULL ``doc_id`` stays NULL; repeated rows have one result
    each. Items with the same id count once. Windows of an item without id hit words but name no
    item. Without documents the result is empty, without items nothing is hit. Other columns are
    neither read nor returned.
    """
    rows = staged(docs, ["doc_id"])
    found, sets = _found(rows, benchmark, window, broadcast_bytes)
    named = broadcast_when_small(kept(items_of(found, sets), "decontaminate-items"))
    found = found.join(named, F.col("item_sets") == F.col("of")).drop("of", "item_sets")
    joined = _beside(rows.select("row", "doc", "n_words"), found)
    none = F.array().cast("array<struct<start:int,stop:int>>")
    return joined.select(
        F.col("doc.doc_id").alias("doc_id"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with all their columns, the words of hit spans cut from ``text``.

    A cut word goes with what stands before it; all else stays as it is, character by character.
    Texts without hits, NULL ones included, are unchanged.
    """
    rows = staged(docs, docs.columns)
    found, _ = _found(rows, benchmark, window, broadcast_bytes)
    joined = _beside(rows.select("row", "doc"), found.select("row", "spans"))
    text = F.col("doc.text")
    between, word = BETWEEN[1:-2], f"[^{BETWEEN[1:-2]}]"
    pieces = F.regexp_extract_all(text, F.lit(f"[{between}]*{word}+"), F.lit(0))
    tail = F.regexp_extract(text, f"[{between}]*$", 0)
    stays = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda s: (i >= s["start"]) & (i < s["stop"])))
    cut = F.when(F.col("spans").isNull(), text).otherwise(F.concat(F.array_join(stays, ""), tail))
    return joined.select(F.col("doc").withField("text", cut).alias("doc")).select("doc.*")


def without_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, share: float = 0.0, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, of whose words at most ``share`` are hit."""
    rows = staged(docs, docs.columns)
    found, _ = _found(rows, benchmark, window, broadcast_bytes)
    joined = _beside(rows.select("row", "doc", "n_words"), found.select("row", "n_hit"))
    return joined.filter(F.coalesce("n_hit", F.lit(0)) <= share * F.col("n_words")).select("doc.*")
