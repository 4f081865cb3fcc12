"""Quality rules, field policy, and publication of the latest and historical products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from parcelwright.functions import text as t

PRECEDENCE = {"proposed": 0, "certified": 1, "certified-with-supplemental": 2}


def rule_measures(rules: list[tuple[str, int, Column, float]]) -> list[Column]:
    """What rules measure of a run, as aggregates for one pass over its rows beside others."""
    return [agg.cast("double").alias(f"_m{i}") for i, (_, _, agg, _) in enumerate(rules)]


def evaluations_of(profile: DataFrame, run: list[str], rules: list[tuple[str, int, Column, float]]) -> DataFrame:
    """evaluate_rules from a table that has the rules' measures of each run."""
    entries = F.array(*(F.struct(F.lit(r).alias("rule_id"), F.lit(v).alias("version"), F.col(f"_m{i}").alias("measured"), F.lit(float(most)).alias("expected")) for i, (r, v, _, most) in enumerate(rules)))
    long = profile.select(*run, F.explode(entries).alias("e")).select(*run, "e.*")
    return long.withColumn("passed", F.coalesce(F.col("measured") <= F.col("expected"), F.lit(False)))


def evaluate_rules(rows: DataFrame, run: list[str], rules: list[tuple[str, int, Column, float]]) -> DataFrame:
    """(run, rule_id, version, measured, expected, passed): a row for each run and rule, passing or not.

    rules are (id, version, aggregate, most). All aggregates share one pass over the rows; an explode of
    the few rules makes them long.
    """
    return evaluations_of(rows.groupBy(*run).agg(*rule_measures(rules)), run, rules)


def publishable_runs(outcomes: DataFrame, blocking: DataFrame, run: list[str]) -> DataFrame:
    """Runs with an accepted outcome and no blocking failure."""
    return outcomes.where("accepted").select(*run).join(blocking.select(*run).distinct(), run, "left_anti")


def accepted_records(records: DataFrame, outcomes: DataFrame, run: list[str]) -> DataFrame:
    """Records of accepted runs: all of a run or none."""
    return records.join(outcomes.where("accepted").select(*run), run, "left_semi")


def stage_duplicates(records: DataFrame, run: list[str], key: list[str]) -> DataFrame:
    """(run, n_keys): runs with keys that stand more than once, found at the end over all of their records."""
    twice = records.groupBy(*run, *key).agg(F.count("*").alias("_n")).where("_n > 1")
    return twice.groupBy(*run).agg(F.count("*").alias("n_keys")).withColumn("code", F.lit("duplicate_record_key"))


def publishable_fields(values: DataFrame, policy: DataFrame) -> DataFrame:
    """Values whose field an approved policy allows; a field without one, or with a blank approver, is never published."""
    approved = F.col("publication_allowed") & t.is_named(F.col("approved_by")) & F.col("approved_at").isNotNull() & t.is_named(F.col("review_reference"))
    return values.join(policy.where(approved).select("source_field").distinct(), "source_field", "left_semi")


def suppress_protected(rows: DataFrame, marker: Column, fields: list[str]) -> DataFrame:
    """rows with the identity fields of marked owners emptied; an unknown marker counts as marked."""
    hidden = F.coalesce(marker, F.lit(True))
    return rows.withColumns({f: F.when(~hidden, F.col(f)) for f in fields})


def latest_release(releases: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """The winning release of each county: newest year, then precedence of its kind, then newest acquisition."""
    rank = reduce(lambda c, kv: c.when(F.col("release_kind") == kv[0], kv[1]), PRECEDENCE.items(), F)
    wanted = releases.where(F.col("release_kind").isin(kinds)) if kinds else releases
    w = W.partitionBy("county").orderBy(F.desc("tax_year"), F.desc(rank), F.desc("as_of"))
    return wanted.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def product(records: DataFrame, publishable: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """Records of each county's winning publishable release. The release is chosen first: accounts it lacks are gone."""
    release = ["county", "tax_year", "release_kind"]
    return records.join(latest_release(publishable, kinds).select(*release), release, "left_semi")


def history_product(records: DataFrame, publishable: DataFrame) -> DataFrame:
    """Records of all publishable releases, each with its release."""
    return records.join(publishable.select("county", "tax_year", "release_kind"), ["county", "tax_year", "release_kind"], "left_semi")


def promote(publications: DataFrame, key: list[str], order: list) -> DataFrame:
    """The next publication table: of each key the newest good build is current, older good ones are superseded.

    Failed builds keep their state, and so does whatever was current before them. Computed as a table; a
    reader's pointer moves only once the new version is written.
    """
    good = F.col("state") == "built"
    newest = F.row_number().over(W.partitionBy(*key, good).orderBy(*order))
    return publications.withColumn("_n", newest).withColumn("state", F.when(~good, F.col("state")).when(F.col("_n") == 1, "current").otherwise("superseded")).drop("_n")


def current_publication(publications: DataFrame) -> DataFrame:
    return publications.where("state = 'current'").drop("state")


def account_lookup(gold: DataFrame, county: int, account: Column) -> DataFrame:
    """One account of a county; on a table partitioned by county, other partitions are not read."""
    return gold.where((F.col("county") == county) & (F.col("account_id") == account))


def write_lookup(records: DataFrame, path: str, rows_per_file: int = 1_000_000, rows_per_group: int = 10_000) -> None:
    """Write records (county, account_id, ...) for look-up by account: a folder a county, accounts in ranges over its files, sorted in
    each, with Bloom filters of accounts. A look-up opens one county, and in its files only row groups that may hold the account.

    Files hold about rows_per_file rows: ranges come from a sample of (county, account_id), so a county of any size
    is many tasks' work.
    """
    files = max(1, -(-records.count() // rows_per_file))
    ranged = records.repartitionByRange(files, "county", "account_id").sortWithinPartitions("county", "account_id")
    writer = ranged.write.partitionBy("county").option("parquet.bloom.filter.enabled#account_id", "true").option("parquet.bloom.filter.expected.ndv#account_id", str(rows_per_group))
    writer.option("parquet.block.row.count.limit", str(rows_per_group)).option("maxRecordsPerFile", rows_per_file).parquet(path)


def lookup(gold: DataFrame, county: int, accounts: list[str], values: list[str], policy: DataFrame, lineage: DataFrame) -> DataFrame:
    """(account_id, source_field, value, and lineage's columns) of some accounts of a county: published fields only, each with
    the release it came from.

    gold has county, account_id, run and the values as columns; policy approves fields (publishable_fields); lineage has a row a run.
    """
    wide = gold.where((F.col("county") == county) & F.col("account_id").isin(accounts))
    long = wide.select("account_id", "run", F.explode(F.create_map(*(x for v in values for x in (F.lit(v), F.col(v).cast("string"))))).alias("source_field", "value"))
    return publishable_fields(long.where("value is not null"), policy).join(lineage, "run")
