"""A corpus from raw documents: five stages, each written as Parquet and read again.

Stages take (spark, docs, sf_dir); all but the last return the columns of docs. The first keeps documents of good
quality, the second takes out repeated passages of lines, the third leaves one document of each group of
near-duplicates, the fourth drops documents with passages of the benchmark, and the last draws the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelwright.llm import decontaminate, lines, mixing, near, quality
from parcelwright.sources import workspace as store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that boosted trees and base rules keep. A text alone decides: repeated rows and ties fare alike; null
    and empty texts go; other columns pass through; an empty table gives an empty one."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of lines that stand earlier, and without those that lost all words by it. Null texts
    pass through; rows of one doc_id and text lose the same lines; the least (doc_id, hash of text, place) is first."""
    return lines.keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id. Null and empty texts, and rows without a
    doc_id, pass through; rows of one doc_id and text stay or go together."""
    return near.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a window of a benchmark item. Null and empty texts pass through, as does all if there are no
    items; rows of one doc_id and text stay or go together."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words it takes of each (repeats counted). Null and empty texts have no words
    and are never taken; null sources are one source; rows of one doc_id share a key, and equal rows are interchangeable."""
    return mixing.mix(docs, whole=True).where("taken > 0").drop("epochs", "drawn")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

#: Trees and sketches have no SQL twin; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
