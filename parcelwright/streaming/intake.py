"""Incremental intake of release files: a stream that drains what is there, against a durable ledger of contents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from parcelwright.operators import match
from parcelwright.sources import files

LEDGER = "member string, length long, sha256 string, partition_key string, classification string, batch long"


class Intake:
    """Takes each delivered file once, and rows of a content once for its logical release.

    partition_of is a pattern whose first group is a file's logical release in its path. ledger has a row a delivered file with its
    digest and whether it was NEW, IDENTICAL (recorded, nothing taken) or DIVERGED from what its release had before.
    """

    def __init__(self, spark: SparkSession, target: str, ledger: str, partition_of: str):
        self.spark, self.target, self.ledger_path, self.partition_of = spark, target, ledger, partition_of

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("basePath", path).parquet(path)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        return self._read(self.ledger_path, LEDGER)

    def taken(self) -> DataFrame:
        return self._read(self.target, "member string, value string, batch long")

    def take(self, batch: DataFrame, number: int) -> None:
        """One batch of lines (member, value). Its ledger entries and rows are folders named by its number: a batch that
        is repeated after a failure sees the ledger of the batches before it, and overwrites what it left."""
        members = batch.select("member").distinct()
        hashed = files.digests(files.sized(members)).withColumn("partition_key", F.regexp_extract("member", self.partition_of, 1))
        before = self.ledger().where(F.col("batch") < number)
        # of files of one batch that bring equal bytes to one release, the first in order of their names counts
        same = W.partitionBy("partition_key", "sha256").orderBy("member")
        ranked = hashed.withColumn("_again", F.row_number().over(same) > 1)
        firsts = W.partitionBy("partition_key", "_again").orderBy("member")
        ranked = ranked.withColumn("_second", ~F.col("_again") & (F.row_number().over(firsts) > 1))
        known = match.classify_artifacts(ranked, before.select("partition_key", "sha256"), ["partition_key"], "sha256")
        verdict = F.when(F.col("_again") & (F.col("classification") == "NEW"), "IDENTICAL").when(F.col("_second") & (F.col("classification") == "NEW"), "DIVERGED").otherwise(F.col("classification"))
        entries = known.withColumn("classification", F.when(F.col("_again") & (F.col("classification") == "DIVERGED"), "IDENTICAL").otherwise(verdict)).drop("_again", "_second")
        path = f"{self.ledger_path}/batch={number}"
        entries.select("member", "length", "sha256", "partition_key", "classification").write.mode("overwrite").parquet(path)
        fresh = self.spark.read.schema("member string, classification string").parquet(path).where("classification <> 'IDENTICAL'").select("member")
        batch.join(fresh, "member", "left_semi").select("member", "value").write.mode("overwrite").parquet(f"{self.target}/batch={number}")

    def run(self, source: str, checkpoint: str) -> None:
        """Drain the text files that match source and stop; the checkpoint remembers files."""
        lines = self.spark.readStream.option("lineSep", "\n").schema("value string").text(source)
        named = lines.select(F.regexp_replace(F.col("_metadata.file_path"), r"\Afile:/+", "file:///").alias("member"), "value")
        named.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(self.take).start().awaitTermination()
