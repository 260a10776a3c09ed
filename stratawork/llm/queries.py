"""The registered corpus queries: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import align, cover_tree, decontaminate, language, line_dedup, mixing, packing, periods, simhash, token_counts, token_files, top_k, toxicity

QUERIES: dict = {}
ORACLES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def oracle(sql: str):
    """Registers SQL that gives a query's rows."""

    def register(function):
        ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by its unsigned crc32."""
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0)
    rows = crc32(token_files.read_token_files(spark, folder))
    return token_files.with_starts(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0, with_ids=False)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op1_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=4, shingle=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


@oracle("""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size
  FROM documents
), sizes AS (
  SELECT doc_id, source, size, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS r, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS s FROM docs
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weights AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM totals
), filled AS (
  SELECT *, sum(source_size) OVER () AS total, sum(cap) OVER upto - cap AS held, sum(weight) OVER () - sum(weight) OVER upto + weight AS free
  FROM weights WINDOW upto AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), unit AS (
  SELECT (1.5::DOUBLE * total - held) / free AS unit FROM filled
  WHERE weight * ((1.5::DOUBLE * total - held) / free) <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1
), rates AS (
  SELECT source, source_size, least(cap, weight * unit) AS target,
    CASE WHEN source_size = 0 THEN 0 ELSE least(cap, weight * unit) / source_size END AS rate
  FROM weights, unit
), tried AS (
  SELECT d.source, k.k, abs(sum(d.size * (floor(rate) + ((d.r + k.k * d.s) % 4294967296 < (rate - floor(rate)) * 4294967296.0::DOUBLE)::INT)) - any_value(target)) AS miss
  FROM sizes d JOIN rates t ON d.source IS NOT DISTINCT FROM t.source, range(64) k(k) GROUP BY d.source, k.k
), seeds AS (
  SELECT source, k FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, k) = 1
)
SELECT d.doc_id, d.size, t.source_size, t.target,
  CAST(d.size * (floor(rate) + ((d.r + e.k * d.s) % 4294967296 < (rate - floor(rate)) * 4294967296.0::DOUBLE)::INT) AS BIGINT) AS taken
FROM sizes d JOIN rates t ON d.source IS NOT DISTINCT FROM t.source JOIN seeds e ON d.source IS NOT DISTINCT FROM e.source
""")
@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: Vectors without NULL and non-finite components; x is NULL or not finite exactly if x - x is not 0.
FINE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: (x - x = 0) IS NOT TRUE)) = 0"


@oracle(f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE {FINE}
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
""")
@query
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k_of_every(table(spark, sf_dir, "embeddings"), every=50, k=5)


@oracle(f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE label IS NOT NULL AND {FINE}
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), roots AS (
  SELECT a, min(b) AS root FROM reached GROUP BY a
), degrees AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, root AS component_id, e.vec_id = root AS kept
FROM embeddings e JOIN roots ON roots.a = e.vec_id LEFT JOIN degrees ON degrees.a = e.vec_id
""")
@query
def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.linked(table(spark, sf_dir, "embeddings"), 0.93)


@query
def op8_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.held_out(docs, 5, 0)
    model = language.fit(docs.filter(~out))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out(found, 5, 0).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op10_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs.select("doc_id", "text"), toxicity_model(spark, docs, sf_dir))
    return found.select(
        "doc_id",
        language.held_out(found, 3, 1).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.CUT).cast("int").alias("predicted"),
    )


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Learns from the labelled rows of ``docs`` that are not held out."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.fit(docs.filter(~language.held_out(docs, 3, 1)), labels.filter(~language.held_out(labels, 3, 1)))


def _words(text: str) -> str:
    """SQL for the words of a text as decontamination takes them."""
    capitals = decontaminate.CAPITALS
    lowered = f"translate({text}, '{capitals}', '{capitals.lower()}')"
    return f"coalesce(list_filter(regexp_split_to_array({lowered}, '{decontaminate.BETWEEN}'), lambda w: w <> ''), [])"


@oracle(f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item, w[s : s + 9] AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT len(gram) AS n FROM grams
), places AS (
  SELECT r, s, n, w[s : s + n - 1] AS gram FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM docs), lengths WHERE s + n - 1 <= len(w)
), found AS (
  SELECT r, s, n, item FROM places JOIN grams USING (gram)
), hit AS (
  SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS i FROM (SELECT DISTINCT r, s, n FROM found)) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""")
@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``docs`` in which a tenth of the ids get a periodic tail: words from ``a`` on repeat the ``p`` words there."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(number / 10)
    rows = docs.select("doc_id", "text", (number % 10).alias("rest"), g.alias("g"), F.array_remove(F.split("text", "[ \\t-\\r]+"), "").alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.try_mod(F.col("g"), F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    planted = (F.col("rest") == 0) & (F.col("n") > 0)
    return rows.select("doc_id", F.when(planted, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(repeated_tails(table(spark, sf_dir, "documents")))

    def longer(best, run):
        return best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.reduce("runs", none, lambda best, run: F.when(longer(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = align.alignments(table(spark, sf_dir, "documents"), *files, with_groups=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
