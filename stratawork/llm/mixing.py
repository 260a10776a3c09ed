"""Mixing sources to target weights: repetition rates from token totals, then whole copies per document.

Sizes are summed per source; targets follow the weights, stopping at a multiple of what a source
has, with the excess shared anew. A document is emitted floor(rate) times plus once more with
probability rate - floor(rate), drawn from a hash of its id, so reruns agree on any cluster.

One draw per document leaves a source's total to chance. Every source may therefore draw with
any of ``SEEDS`` seeds; all are added up in the same pass and the source takes the seed whose total
comes closest to its target. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratawork.operators.joins import broadcast_when_small

from .storage import fresh, kept, numbered

SEEDS = 64
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Runs of characters other than ASCII blanks; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows with ``source`` and ``size``.

    Sources by code point (NULL last) take the ``weights`` in turn and share ``share`` times all
    sizes; no target exceeds ``most`` times its source. Each round caps the sources above that and
    shares the rest; two sums per round reach the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "sources")
    turn = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = kept(ranked.withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(most))), "source-weights")
    whole = ranked.agg(F.sum("source_size")).first()[0] or 0
    unit, capped = None, None
    while True:
        is_capped = F.lit(False) if unit is None else F.col("weight") * F.lit(unit) > F.col("cap")
        held, free, n = ranked.select(
            F.coalesce(F.sum(F.when(is_capped, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("weight"))), F.lit(0.0)),
            F.count_if(is_capped),
        ).first()
        if n == capped:
            break
        capped = n
        unit = (share * whole - held) / free if free else 0.0
    return ranked.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(unit)).alias("target"))


def hash_part(doc_id: str | Column, at: int) -> Column:
    """Eight hexadecimal digits of the hash of the document's id, from digit ``at`` on, as a number."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, at, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``copies`` of every row.

    NULL texts have size 0, a NULL source is a source of its own, repeated rows draw alike. A
    source without words has target 0 and no copies. Other columns are ignored.
    """
    sized = docs.select(F.col("doc_id"), "source", word_count("text").alias("size"))
    # seed k draws r + k * s, modulo 2^32
    sized = kept(sized.withColumn("r", hash_part("doc_id", 1)).withColumn("s", hash_part("doc_id", 9)), "sizes")
    targets = source_targets(sized, weights, share, most)
    rate = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    rates = targets.withColumn("whole", F.floor(rate).cast("long")).withColumn("part", (rate - F.floor(rate)) * F.lit(float(1 << 32)))
    rates = kept(rates.withColumnRenamed("source", "of"), "rates")
    rows = sized.join(broadcast_when_small(rates), sized["source"].eqNullSafe(rates["of"]))

    def copies(seed: int | Column) -> Column:
        hit = (F.col("r") + seed * F.col("s")) % F.lit(1 << 32) < F.col("part")
        return F.col("whole") + F.when(hit, 1).otherwise(0)

    taken = rows.groupBy("of").agg(
        F.first("target").alias("target"), *[F.sum(F.col("size") * copies(F.lit(k))).alias(f"taken{k}") for k in range(SEEDS)]
    )
    misses = F.array(*[F.struct(F.abs(F.col(f"taken{k}") - F.col("target")).alias("miss"), F.lit(k).alias("seed")) for k in range(SEEDS)])
    seeds = taken.select(F.col("of").alias("seed_of"), F.array_min(misses)["seed"].alias("seed"))
    chosen = rates.join(seeds, rates["of"].eqNullSafe(seeds["seed_of"])).drop("seed_of")
    chosen = kept(chosen, "chosen-rates")
    rows = sized.join(broadcast_when_small(chosen), sized["source"].eqNullSafe(chosen["of"]))
    return rows.select("doc_id", "source", "size", "source_size", "target", copies(F.col("seed")).alias("copies"))


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all their columns, as often as the mix takes them.

    Rows are told apart by ``doc_id``, source and text size; equal ones draw alike, so any of them stands for all.
    """
    names = fresh(docs, "mix_id", "mix_source", "mix_size", "copies", "copy")
    plan = mix(docs, **options).select("doc_id", "source", "size", "copies").filter("copies > 0").distinct()
    plan = kept(plan.toDF(*names[:4]), "copies")
    id_, source, size, copies, copy = names
    same = docs["doc_id"].eqNullSafe(plan[id_]) & docs["source"].eqNullSafe(plan[source]) & (word_count(docs["text"]) == plan[size])
    rows = docs.join(plan, same).withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int"))))
    return rows.drop(*names)
