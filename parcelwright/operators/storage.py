"""Artifacts, idempotent appends, exports with manifests, and quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelwright.sources import files


def content_keys(df: DataFrame, content: Column, locator: Column) -> DataFrame:
    """(sha256, n, locator, byte_count): distinct contents; equal bytes are one artifact, found first at the least locator."""
    keyed = df.select(F.sha2(content.cast("binary"), 256).alias("sha256"), locator.alias("locator"), F.octet_length(content).cast("long").alias("byte_count"))
    return keyed.groupBy("sha256").agg(F.count("*").alias("n"), F.min("locator").alias("locator"), F.min("byte_count").alias("byte_count"))


def content_inventory(spark: SparkSession, path: str, chunk_bytes: int = files.CHUNK_BYTES) -> DataFrame:
    """content_keys of the files under path, empty ones too; each is streamed in chunks in one task, so none is too large."""
    hashed = files.digests(files.listing(spark, path).repartition(spark.sparkContext.defaultParallelism), chunk_bytes)
    return hashed.groupBy("sha256").agg(F.count("*").alias("n"), F.min("member").alias("locator"), F.min("length").alias("byte_count"))


def same_key(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    """Null-safe equality of the whole key: null is a value like others."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in key))


def append_idempotent(new: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new to append: one for each key that existing lacks. Nulls in keys are not distinct."""
    fresh = new.dropDuplicates(key)
    return fresh.join(existing.select(*key).distinct().alias("old"), same_key(fresh, existing, key), "left_anti")


def append_records(new: DataFrame, path: str, key: list[str]) -> None:
    """Append what the table at path lacks of new. The write is one job that commits at its end, so a run that is repeated, whether
    it failed before or not, leaves every key once."""
    spark = new.sparkSession
    try:
        existing = spark.read.schema(new.schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        existing = new.limit(0)
    append_idempotent(new, existing, key).write.mode("append").parquet(path)


def split_quarantine(records: DataFrame, outcomes: DataFrame, release: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records of accepted releases, and those of all others; outcomes has a row and an `accepted` flag for each release."""
    good = outcomes.where("accepted").select(*release)
    return records.join(good, release, "left_semi"), records.join(good, release, "left_anti")


def row_digest(columns: list[str]) -> Column:
    """A number of 48 bits from a row's values as text, by name; sums of it depend on no order."""
    row = F.to_json(F.struct(*(F.col(f"`{c}`").cast("string").alias(c) for c in sorted(columns))), {"ignoreNullFields": "false"})
    return F.conv(F.substring(F.sha2(row.cast("binary"), 256), 1, 12), 16, 10).cast("decimal(20,0)")


def bulk_export(df: DataFrame, path: str, by: list[str], rows_per_file: int = 1_000_000) -> DataFrame:
    """Write df as Parquet partitioned by `by`; the manifest has a row a file: by, member, n_rows, checksum, length, sha256.

    A partition's rows are counted first and dealt to as many files as they ask for, so that none is one task's. Rows and checksum are read
    back from the file itself, bytes are hashed as they lie.
    """
    spark = df.sparkSession
    sizes = df.groupBy(*(F.col(k).alias(f"_by_{k}") for k in by)).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_files"))
    dealt = df.join(sizes, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in by))).select(*df.columns, "_files")
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(*(c for c in df.columns)), F.col("_files")))
    dealt.repartition(*by, "_part").drop("_files", "_part").write.option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)
    return manifest(spark, path, df.schema, by)


def manifest(spark: SparkSession, path: str, schema, by: list[str]) -> DataFrame:
    """The manifest of an export as it lies there now: by, member, n_rows, checksum, length, sha256."""
    member = F.regexp_replace(F.col("_metadata.file_path"), r"\Afile:/+", "file:///").alias("member")
    back = spark.read.schema(schema).parquet(path).select("*", member)
    counted = back.groupBy(*by, "member").agg(F.count("*").alias("n_rows"), F.sum(row_digest([f.name for f in schema])).alias("checksum"))
    hashed = files.digests(files.listing(spark, path).where(F.col("member").endswith(".parquet")))
    return counted.join(hashed, "member").select(*by, "member", "n_rows", "checksum", "length", "sha256")


def manifest_faults(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """(member, code) of an export's files against its recorded manifest: missing, unexpected, or with other rows or bytes."""
    r, f = (x.select("member", F.struct("n_rows", "checksum", "length").alias("rows"), F.col("sha256").alias("sha")) for x in (recorded, found))
    met = r.alias("r").join(f.alias("f"), "member", "full_outer")
    code = F.when(F.col("f.sha").isNull(), "missing_file").when(F.col("r.sha").isNull(), "unexpected_file").when(F.col("f.sha") != F.col("r.sha"), "bytes_differ").when(F.col("f.rows") != F.col("r.rows"), "rows_differ")
    return met.select("member", code.alias("code")).where("code is not null")
