"""Tables and files that a job writes for itself, in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from parcelwright.sources import files

#: The folder of the round that this thread is in.
ROUND: ContextVar[str] = ContextVar("ROUND", default="")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a session on one machine may leave it unset; it gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"file://{tempfile.gettempdir()}/parcelwright-shared"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{ROUND.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def in_round(spark: SparkSession, name: str) -> Iterator[None]:
    """All that is written inside goes to a folder of its own, which is deleted at the end: no lazy result may outlive it."""
    path = new_path(spark, name)
    before = ROUND.set(path)
    try:
        yield
    finally:
        ROUND.reset(before)
        files.remove(path)


#: Spark's switch for removing an execution's shuffle files at its end; else they go when its cleaner finds them unused.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs inside are gone once it has run, so later steps don't add theirs to them."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: it cuts lineage and outlives executors.

    With drop_shuffles, the files of its shuffles are gone once it is written.
    """
    path = new_path(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession) if drop_shuffles else nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
