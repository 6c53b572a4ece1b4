"""Rows that once crashed an operator or took another row's result."""

import numpy as np
from pyspark.sql import functions as F

from bookflow.llm import language_id, suffix_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string"


def test_language_id_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some words", None, "s"), (1, "some words", None, "s"), (None, None, None, None)], DOCS)
    got = language_id.predict(docs, language_id.train(docs)).collect()
    assert [(r.doc_id, r.lang_pred, r.score) for r in got] == [(1, "und", 0.0), (1, "und", 0.0), (None, "und", 0.0)]
    empty = docs.limit(0)
    assert language_id.predict(empty, language_id.train(empty)).collect() == []


def test_toxicity_batch_without_gradient_and_empty_tables(spark):
    model = toxicity.Model(["a"])
    model.bias[:] = -100  # every filter is shut, so no word gets a gradient
    toxicity._train(model, ["a b c", "d e"], np.array([1, 0], np.float32), 1)
    assert model.trained and np.isfinite(model.score(toxicity._words(["a b", ""]))).all()
    docs = spark.createDataFrame([(1, "a b", "x", "s"), (2, None, None, None)], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert [(r.doc_id, r.score, r.predicted) for r in got] == [(1, 0.0, 0), (2, 0.0, 0)]
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).collect() == []


def test_suffix_dedup_tells_texts_without_id_apart(spark):
    """Texts whose 32-bit hashes agree, all without an id or all with one: only the one that stands twice is cut."""
    made = spark.range(300_000).select(F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("text"))
    pairs = made.groupBy(F.hash("text").alias("h")).agg(F.sort_array(F.collect_list("text")).alias("t")).filter("size(t) > 1").orderBy("h").limit(1).collect()
    a, b = pairs[0].t[:2]
    c = "x" + a  # holds all of a
    for one in (None, 5):
        rows = spark.createDataFrame([(one, a), (one, b), (one, c)], "doc_id long, text string")
        got = {r.text: r.n_removed for r in suffix_dedup.remove_repeats(rows).collect()}
        assert got == {a: len(a), b: 0, c: len(a)}
