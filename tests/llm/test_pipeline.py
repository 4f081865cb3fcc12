"""The pipeline's stages on one small corpus with odd rows and clashing columns."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelwright.llm import decontaminate, quality
from tests.llm.test_near import brute

BLANK = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    filler = docs.where("length(text) > 1500 and lang = 'en'").orderBy("doc_id").first().text[:900]
    odd = [(-1, None, "en", None, 0), (-2, "", None, "x", None), (-3, f"{filler} {item}", "en", "src0", 1), (None, filler + " more", "en", "src1", 1)]
    out = [docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("size", F.lit("mine")).withColumn("kept", F.lit(7)).withColumn("th", F.lit(1)).withColumn("n_lines", F.lit(2)).persist()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_dir).persist())
    return out


def test_columns(steps):
    assert all(x.columns == steps[0].columns for x in steps[:-1])
    assert {"doc_id", "text", "size", "taken", "target"} <= set(steps[-1].columns)


def test_quality(spark, steps, sf_dir):
    trees = quality.fit(steps[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = Counter((r.doc_id, r.text) for r in quality.score(steps[0], trees).where("kept").collect())
    assert Counter((r.doc_id, r.text) for r in steps[1].collect()) == want
    assert 0 < steps[1].count() < steps[0].count()


def test_lines(steps):
    before = {r.doc_id: r.text for r in steps[1].collect()}
    after = {r.doc_id: r.text for r in steps[2].collect()}
    assert set(after) <= set(before)
    for d, t in after.items():
        left = Counter(t.split("\n"))
        left.subtract(Counter(before[d].split("\n")))
        assert max(left.values()) <= 0 and re.search(BLANK, t)


def test_near(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect() if r.doc_id is not None]
    want = {d for d, _, _, kept in brute(rows) if kept}
    assert {r.doc_id for r in steps[3].collect()} - {None} == want


def test_decontamination(spark, steps, sf_dir):
    bad = {r.doc_id for r in decontaminate.contamination(steps[3], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").collect()}
    assert Counter(r.doc_id for r in steps[4].collect()) == Counter(r.doc_id for r in steps[3].collect() if r.doc_id not in bad)


def test_mix(steps):
    total = sum(len(re.findall(BLANK, r.text or "")) for r in steps[4].collect())
    got = steps[5].collect()
    assert abs(sum(r.taken for r in got) - total) < 0.1 * total
    assert all(0 < r.taken <= 3 * r.size and r.size == len(re.findall(BLANK, r.text)) for r in got)


def test_run_and_empty(spark, sf_dir, steps):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
