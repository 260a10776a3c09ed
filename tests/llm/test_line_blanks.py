"""Lines that differ in the blanks between their words alone are equal."""

from stratawork.llm import line_dedup


def test_blanks_inside_a_line_do_not_matter(spark):
    words = [f"word{k}" for k in range(60)]
    texts = [" ".join(words), "  ".join(words), "\t".join(words), "\u00a0".join(words), "\u2003 ".join(words), " ".join(words[::-1])]
    texts = [t + ".\n" for t in texts]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.without_repeats(docs).collect()}
    assert got == {0: (texts[0], 0), **{k: ("", 1) for k in range(1, 5)}, 5: (texts[5], 0)}
