"""Nulls in every column, and repeated rows, through the operators that join rows back."""

from collections import Counter

from pyspark.sql import functions as F

from parcelwright.llm import decontaminate, lines, mixing, near, ngrams, toxicity

TEXT = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ROWS = [(None, None, None), (None, TEXT, None), (None, TEXT, "a"), (1, TEXT, "a"), (1, TEXT, "a"), (2, None, "b"), (3, f"{TEXT}\n{TEXT}", None)]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


def test_near(spark):
    got = near.near_duplicates(frame(spark)).collect()
    assert len(got) == len(ROWS)
    assert {r.component_id for r in got if r.doc_id == 1} == {1}
    kept = near.keep_one(frame(spark)).collect()
    assert Counter(r.doc_id for r in kept) == Counter([None, None, None, 1, 1, 2, 3])


def test_lines(spark):
    got = lines.dedup_lines(frame(spark)).collect()
    assert len(got) == len(ROWS) and sum(r.text is None for r in got) == 2
    assert lines.line_report(frame(spark)).count() == len(ROWS)


def test_contamination(spark):
    bench = spark.createDataFrame([(None, TEXT), (1, None), (2, "x")], "item_id long, text string")
    assert decontaminate.contamination(frame(spark), bench).count() == len(ROWS)
    assert Counter(r.doc_id for r in decontaminate.decontaminate(frame(spark), bench).collect()) == Counter([None, 2])  # the texts of items count, with or without an id


def test_mix_scores_and_models(spark):
    assert sum(r.taken for r in mixing.mix(frame(spark)).collect()) > 0
    assert ngrams.lm_scores(frame(spark)).count() == len(ROWS)
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 0), (3, 1)], "doc_id long, toxic int")
    assert toxicity.score(frame(spark), toxicity.fit(frame(spark), labels)).where(F.col("score").between(0, 1)).count() == len(ROWS)
