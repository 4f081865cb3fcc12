"""The dealt operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelwright.llm import alignment, chat, decontaminate, licenses, lines, mixing, near, ngrams, packing, quality, search, toxicity, urls

#: The conversation that is added to the given ones.
EXTRA_TURNS = (
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.lm_scores(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_windows(turns))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hits", "th")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), trees).drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_lm_score, op3_source_mix, op4_chat_windows, op5_near_duplicates, op6_line_dedup, op7_decontaminate, op8_url_filter, op9_quality_rules, op10_toxicity, op11_pack_windows, op12_align_tokens, op13_ranked_search)}
