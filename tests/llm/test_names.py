"""Extra columns that bear the operators' own names change nothing and come through unchanged."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from stratawork.llm import align, cover_tree, decontaminate, language, line_dedup, mixing, packing, periods, queries, simhash, similar, token_counts, token_files, top_k, toxicity

#: Names that some operator uses for columns of its own.
OWN = """key_id key_hash gone __gone n_removed lines text_hash mark first last high low place mix_id mix_source mix_size copies copy __copy
r s of size seed rank weight cap node own_id own_hash own_text f0 f1 hub fp bucket star near a b ok group root stay_id stay_hash __row
component_id toxic_score label_id toxic words ids piece start stop length sequence_id offset row doc n_words spans item_set n_hit
shard dim tile matrix vector q_ids query_id vec cell level centre label2 pairs times pair count best top sum_row run runs period chunk n
heads tails part pos control data __part __pos counts score lang_pred rejected blocks block known class""".split()

TEXTS = [
    "one two three four five six seven eight nine ten. " * 7,
    "something else stands here, quite short",
    "one two three four five six seven eight nine ten. " * 7 + "And a tail of its own follows here.",
    None, "", "x y x y x y x y x y", "something else stands here, quite short",
]


def extra(df):
    return df.withColumns({name: F.lit(7) for name in OWN if name not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", "ab"[k % 2], len(t or "")) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


TOKENS = queries.public_tokenizers.path
WHOLE = {
    "simhash.near_duplicates": lambda d: simhash.near_duplicates(d),
    "similar.near_duplicates": lambda d: similar.near_duplicates(d),
    "line_dedup.repeated_lines": lambda d: line_dedup.repeated_lines(d),
    "mixing.mix": lambda d: mixing.mix(d),
    "token_table": lambda d: token_files.token_table(d, TOKENS("byte_bpe_50k.json"), 0),
    "packed": lambda d: packing.packed_documents(d, TOKENS("word_bpe_49k.json"), 16, 0).drop("sequence_id", "offset"),
    "token_counts": lambda d: token_counts.token_counts(d, TOKENS("byte_bpe_50k.json")),
    "alignments": lambda d: align.alignments(d, TOKENS("byte_bpe_50k.json"), TOKENS("piece_bpe_32k.model")),
    "periodic_runs": lambda d: periods.periodic_runs(d),
    "contamination": lambda d: decontaminate.contamination(d, d.select(F.col("doc_id").alias("item_id"), "text", *OWN[:3]) if "gone" in d.columns else d.select(F.col("doc_id").alias("item_id"), "text"), 4),
    "language": lambda d: language.predict(d, language.fit(d)),
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_results_of_their_own(docs, name):
    plain, named = WHOLE[name](docs), WHOLE[name](extra(docs))
    assert plain.columns == named.columns
    assert rows_of(plain, plain.columns) == rows_of(named, plain.columns)


PASSING = {
    "simhash.representatives": lambda d: simhash.representatives(d),
    "similar.representatives": lambda d: similar.representatives(d),
    "without_repeats": lambda d: line_dedup.without_repeats(d),
    "emitted": lambda d: mixing.emitted(d),
    "toxicity.score": lambda d: toxicity.score(d, None),
    "without_spans": lambda d: decontaminate.without_spans(d, d.select(F.col("doc_id").alias("item_id"), "text").filter("doc_id = 5"), 4),
    "without_documents": lambda d: decontaminate.without_documents(d, d.select(F.col("doc_id").alias("item_id"), "text").filter("doc_id = 5"), 4),
}
#: Results that replace a column of their name.
NEW = {"without_repeats": {"n_removed"}, "toxicity.score": {"toxic_score"}}


@pytest.mark.parametrize("name", sorted(PASSING))
def test_rows_that_come_through(docs, name):
    plain, named = PASSING[name](docs), PASSING[name](extra(docs))
    own = [*docs.columns, *NEW.get(name, ())]
    assert set(named.columns) == set(extra(docs).columns) | NEW.get(name, set())
    assert rows_of(plain, own) == rows_of(named, own)
    kept = [c for c in OWN if c not in own]
    assert {tuple(r) for r in named.select(*kept).collect()} <= {(7,) * len(kept)}


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages(spark, sf, docs, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    plain, named = run(spark, docs, sf), run(spark, extra(docs), sf)
    if stage == "pack":
        own = [c for c in plain.columns if c not in ("sequence_id", "offset")]
    else:
        own = docs.columns
        assert named.columns == extra(docs).columns
        others = [c for c in OWN if c not in own]
        assert {tuple(r) for r in named.select(*others).collect()} <= {(7,) * len(others)}
    assert rows_of(plain, own) == rows_of(named, own)


def test_vectors(spark):
    rows = [(k, "ab"[k % 2], [float(k % 5), 1.0, float(k % 3)]) for k in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    for run in (lambda d: cover_tree.linked(d, 0.93), lambda d: top_k.top_k_of_every(d, 10)):
        plain, named = run(vectors), run(extra(vectors))
        assert rows_of(plain, plain.columns) == rows_of(named, plain.columns)


def test_rows_that_share_an_id(spark, tmp_path):
    """Every row is a candidate, also where another one has its id."""
    from harness import connect, difference

    rows = [(50, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (1, [0.9, 0.0]), (50, [0.0, 1.0]), (2, [0.0, 0.7]), (3, None), (None, [9.0, 9.0])]
    rows = [(v, "x", e) for v, e in rows]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "t"))
    [part] = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]
    part.rename(tmp_path / "embeddings.parquet")
    sql = queries.ORACLES["op7_top_k"]
    got = queries.QUERIES["op7_top_k"](spark, str(tmp_path))
    assert difference(got, connect(str(tmp_path)), sql) is None
    scores = [r.score for r in got.orderBy("rank").collect()]
    assert scores == [58880, 58880, 45824, 32768, 0]
