"""Artifacts against references, property matching, and snapshots against each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelwright.functions import text as t


def classify_artifacts(candidates: DataFrame, references: DataFrame, partition: list[str], checksum: str) -> DataFrame:
    """candidates with NEW, IDENTICAL or DIVERGED; a partition with several known checksums stays DIVERGED.

    Known checksums are counted, and met by equality: their sets are never gathered.
    """
    known = references.groupBy(*partition).agg(F.count_distinct(checksum).alias("_n"))
    same = references.select(*partition, checksum).distinct().withColumn("_same", F.lit(True))
    met = candidates.join(known, partition, "left").join(same, [*partition, checksum], "left")
    state = F.when(F.col("_n").isNull(), "NEW").when((F.col("_n") > 1) | F.col("_same").isNull(), "DIVERGED").otherwise("IDENTICAL")
    return met.withColumn("classification", state).drop("_n", "_same")


def dangling_references(refs: DataFrame, artifacts: DataFrame, key: str, compare: dict[str, str]) -> DataFrame:
    """refs whose artifact is missing, or differs in a compared column (reference column: artifact column)."""
    a = artifacts.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_a_{c}") for c in compare.values()))
    met = refs.join(a, refs[key] == a["_k"], "left")
    code = F.coalesce(F.when(F.col("_k").isNull(), "missing_artifact"), *(F.when(~F.col(r).eqNullSafe(F.col(f"_a_{c}")), f"{c}_mismatch") for r, c in compare.items()))
    return met.withColumn("code", code).where("code is not null").select(*refs.columns, "code")


def blocking_failures(evaluations: DataFrame, rules: DataFrame) -> DataFrame:
    """Failed evaluations whose pinned rule version is blocking."""
    return evaluations.where(~F.col("passed")).join(rules.where("severity = 'blocking'").select("rule_id", "version"), ["rule_id", "version"])


def exact_match(accounts: DataFrame, props: DataFrame, key: list[str]) -> DataFrame:
    """Pairs of equal county-qualified identity, confidence 1."""
    return accounts.join(props, key).withColumn("method", F.lit("exact")).withColumn("confidence", F.lit(1.0))


def candidate_match(accounts: DataFrame, props: DataFrame, exact: DataFrame, account_key: str, county: str, address: str) -> DataFrame:
    """Candidates by county and normalized address for accounts without an exact match; never merged with those.

    An address that is blank once it is normalized is no evidence, and pairs with nothing.
    """
    open_, named = _open_sides(accounts, props, exact, account_key, address)
    return open_.join(named, [county, "_address"]).withColumn("method", F.lit("candidate")).withColumn("confidence", F.lit(0.5))


def _open_sides(accounts: DataFrame, props: DataFrame, exact: DataFrame, account_key: str, address: str) -> tuple[DataFrame, DataFrame]:
    named = lambda df: df.withColumn("_address", t.normalize_address(F.col(address))).where("_address <> ''").drop(address)
    return named(accounts.join(exact.select(account_key).distinct(), account_key, "left_anti")), named(props)


def bounded_candidates(accounts: DataFrame, props: DataFrame, exact: DataFrame, account_key: str, prop_key: str, county: str, address: str, most_pairs: int = 100) -> tuple[DataFrame, DataFrame]:
    """Candidates whose number grows with the rows and not with the square of an address that many share.

    Blocks (county, normalized address) are counted first. Of a block with at most most_pairs pairs, all pairs come (as from candidate_match). A
    greater one is a class: each account and each property is a row (county, address, side, key) of the second result, with how many
    accounts and properties share the address. So nothing is left out: a class stands for all pairs of its two sides.
    Returns (pairs, classes).
    """
    left, right = _open_sides(accounts, props, exact, account_key, address)
    n_left = left.groupBy(county, "_address").agg(F.count("*").alias("n_accounts"))
    n_right = right.groupBy(county, "_address").agg(F.count("*").alias("n_properties"))
    blocks = n_left.join(n_right, [county, "_address"])
    many = F.col("n_accounts") * F.col("n_properties") > most_pairs
    few, great = blocks.where(~many).select(county, "_address"), blocks.where(many)
    by = [county, "_address"]
    pairs = left.join(few, by, "left_semi").join(right, by).withColumn("method", F.lit("candidate")).withColumn("confidence", F.lit(0.5))
    side = lambda df, key, name: df.select(*by, F.lit(name).alias("side"), F.col(key).cast("string").alias("key")).join(great, by)
    classes = side(left, account_key, "account").unionByName(side(right, prop_key, "property"))
    return pairs, classes.withColumnRenamed("_address", "address")


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str], facts: list[str]) -> DataFrame:
    """Every key with added, removed, changed or retained; facts are compared with nulls as values."""
    o = old.select(*key, F.struct(*facts).alias("_o"))
    n = new.select(*key, F.struct(*facts).alias("_n"))
    same = reduce(lambda a, b: a & b, (F.col(f"_o.{f}").eqNullSafe(F.col(f"_n.{f}")) for f in facts))
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(same, "retained").otherwise("changed")
    return o.join(n, key, "full_outer").select(*key, change.alias("change"))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number differs: the row, n in a, n in b. One aggregation over both sides, with partial sums."""
    columns = a.columns
    both = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    return both.groupBy(*columns).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b")).where("n_a <> n_b")


def full_replacement(records: DataFrame, winners: DataFrame, release: list[str]) -> DataFrame:
    """Records of the winning releases only: accounts that the winner lacks are gone from the current state."""
    return records.join(winners.select(*release), release, "left_semi")


def history(*snapshots: DataFrame) -> DataFrame:
    """All retained versions, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), snapshots)


def qualified_identities(accounts: DataFrame, county: str, account: str, by: list[str]) -> DataFrame:
    """How many account ids there are, and how many once the county qualifies them."""
    return accounts.groupBy(*by).agg(F.count_distinct(account).alias("n_ids"), F.count_distinct(county, account).alias("n_qualified"))


def shared_partitions(refs: DataFrame, checksum: Column, partition: Column) -> DataFrame:
    """Checksums that several logical releases reference, with how many."""
    return refs.select(checksum.alias("sha256"), partition.alias("p")).groupBy("sha256").agg(F.count_distinct("p").alias("n_partitions"), F.count("*").alias("n_references")).where("n_partitions > 1")
