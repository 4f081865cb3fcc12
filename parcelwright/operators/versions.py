"""Published products as version folders and a pointer that is written last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from parcelwright.sources import files

STATES = "publication long, product string, county string, state string, version long, published_at timestamp, superseded_at timestamp, superseded_by long"


class Publications:
    """Versions of products under root.

    data/version=n has the records of the n-th promotion, pointer/version=n the publication table as it stands after it: which
    publication is current for each (product, county), which are superseded by what, and which builds failed. A version counts once
    its pointer is complete; whatever a promotion left that failed before that is never seen.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def version(self) -> int:
        """The newest complete version, 0 if there is none. A reader asks once and reads all of that version."""
        found = [0]
        for folder, is_folder, _ in files.entries(f"{self.root}/pointer"):
            if is_folder and files.exists(f"{folder}/_SUCCESS"):
                found.append(int(folder.rsplit("=", 1)[1]))
        return max(found)

    def table(self, version: int | None = None) -> DataFrame:
        """The publication table of a version, the newest unless one is named."""
        version = self.version() if version is None else version
        return self.spark.read.schema(STATES).parquet(f"{self.root}/pointer/version={version}") if version else self.spark.createDataFrame([], STATES)

    def read(self, schema: str, version: int | None = None) -> DataFrame:
        """Records that consumers read at a version: those of current publications. schema has product, county and what else is read of
        a record; the version of each record's data comes with it."""
        schema = f"{schema}, version long"
        current = self.table(version).where("state = 'current'")
        versions = [r.version for r in current.select("version").distinct().collect()]
        if not versions:
            return self.spark.createDataFrame([], schema).join(current.select("product", "county", "version"), ["product", "county", "version"])
        data = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*(f"{self.root}/data/version={v}" for v in versions))
        return data.join(current.select("product", "county", "version"), ["product", "county", "version"])

    def promote(self, builds: DataFrame, records: DataFrame, publishable: DataFrame) -> int:
        """Publish builds (publication, product, county, run, state, published_at) with their records (product, county, run, ...).

        A build becomes current if it was built and its run is publishable (accepted, no blocking failure); all others are kept as failed, and
        what was current before them stays. Of several good builds of one (product, county) the newest is current, the others
        superseded by it. Records are written first; the pointer is written last, and only if no (product, county) has two
        current publications. Two promotions at once write one pointer folder: the second fails.
        """
        before = self.version()
        version = before + 1
        runs = publishable.select("run").distinct().withColumn("_ok", F.lit(True))
        judged = builds.join(runs, "run", "left").withColumn("state", F.when((F.col("state") == "built") & F.col("_ok"), "good").otherwise("failed"))
        key = W.partitionBy("product", "county").orderBy(F.desc("published_at"), F.desc("publication"))
        good = judged.where("state = 'good'")
        ranked = good.withColumn("_rank", F.row_number().over(key)).withColumns({"_next": F.lag("publication").over(key), "_at": F.lag("published_at").over(key)})
        fresh = ranked.select("publication", "product", "county", F.when(F.col("_rank") == 1, "current").otherwise("superseded").alias("state"), F.lit(version).cast("long").alias("version"), "published_at", F.col("_at").alias("superseded_at"), F.col("_next").alias("superseded_by"))
        failed = judged.where("state = 'failed'").select("publication", "product", "county", "state", F.lit(version).cast("long").alias("version"), F.lit(None).cast("timestamp").alias("published_at"), F.lit(None).cast("timestamp").alias("superseded_at"), F.lit(None).cast("long").alias("superseded_by"))
        oldest = W.partitionBy("product", "county").orderBy("published_at", "publication")
        heirs = fresh.withColumn("_n", F.row_number().over(oldest)).where("_n = 1").select("product", "county", F.col("publication").alias("_by"), F.col("published_at").alias("_when"))
        old = self.table(before).join(heirs, ["product", "county"], "left")
        replaced = (F.col("state") == "current") & F.col("_by").isNotNull()
        old = old.withColumns({"superseded_at": F.when(replaced, F.col("_when")).otherwise(F.col("superseded_at")), "superseded_by": F.when(replaced, F.col("_by")).otherwise(F.col("superseded_by")), "state": F.when(replaced, "superseded").otherwise(F.col("state"))}).drop("_by", "_when")
        table = fresh.unionByName(failed).unionByName(old)

        current = ranked.where("_rank = 1").select("product", "county", "run")
        data = f"{self.root}/data/version={version}"
        records.join(current, ["product", "county", "run"], "left_semi").write.mode("overwrite").parquet(data)
        if table.where("state = 'current'").groupBy("product", "county").count().where("count > 1").take(1):
            raise ValueError("a product of a county would have two current publications")
        self._point(table, version)
        return version

    def _point(self, table: DataFrame, version: int) -> None:
        table.select(*(f"{c.split()[0]}" for c in STATES.split(", "))).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/pointer/version={version}")
