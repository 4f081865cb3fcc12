"""Release accounting: outcomes, retained evidence, progress, and profiles of keys and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

RETAINED = 100


def release_outcome(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row a release of rows (by, physical_row_number, diagnostics): counts, verdict and what is committed.

    A release is accepted without a diagnostic; rows before its first rejected one count as staged, and all or none
    are committed. Two passes of partial aggregation; no row is windowed.
    """
    n = F.size("diagnostics")
    agg = rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(n > 0).alias("n_rejected"),
        F.sum(n).cast("long").alias("n_diagnostics"),
        F.min(F.when(n > 0, F.col("physical_row_number"))).alias("first_rejected"),
    )
    staged = rows.join(agg.select(*by, "first_rejected"), by).groupBy(*by).agg(F.count_if(F.col("first_rejected").isNull() | (F.col("physical_row_number") < F.col("first_rejected"))).alias("n_staged"))
    accepted = F.col("n_rejected") == 0
    return agg.join(staged, by).withColumn("accepted", accepted).withColumn("n_committed", F.when(accepted, F.col("n_staged")).otherwise(0)).withColumn("disposition", F.when(accepted, "accepted").otherwise("record_rejected"))


def retain(entries: DataFrame, by: list[str], order: list, n: int = RETAINED) -> DataFrame:
    """The first n entries of each release in order, with its total and whether some were left out.

    The bare rank limit lets Spark drop rows before the shuffle's sort; totals come from a count of their own.
    """
    first = entries.withColumn("ordinal", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("ordinal") <= n)
    first = first.withColumn("ordinal", F.col("ordinal").cast("long"))
    totals = entries.groupBy(*by).agg(F.count("*").alias("total"))
    return first.join(totals, by).withColumn("truncated", F.col("total") > n)


def progress(counts: DataFrame, by: list[str], interval: int) -> DataFrame:
    """(by, sequence, rows): an event at each full interval and a final one, for releases (by, n_rows)."""
    points = F.array_append(F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_rows") / interval)), lambda i: i > 0), lambda i: i * interval), F.col("n_rows").cast("long"))
    return counts.select(*by, F.posexplode(points).alias("sequence", "rows"))


def staged_progress(rows: DataFrame, by: list[str], interval: int) -> DataFrame:
    """(by, sequence, rows, staged, final): what a release's progress events say, for rows (by, physical_row_number, n_records, rejected).

    An event stands at each full interval and one at the end. staged are the records of rows before the first rejected one, for nothing is
    staged after it. Rows are summed up by interval first; running sums go over intervals, never over rows, and an interval
    that a rejected row cuts short counts what stands before that row.
    """
    first = rows.groupBy(*by).agg(F.min(F.when(F.col("rejected"), F.col("physical_row_number"))).alias("_first"), F.count("*").alias("_n"))
    open_ = F.col("_first").isNull() | (F.col("physical_row_number") < F.col("_first"))
    slot = F.floor((F.col("physical_row_number") - 1) / interval)
    parts = rows.join(first.select(*by, "_first"), by).groupBy(*by, slot.alias("_slot")).agg(F.coalesce(F.sum(F.when(open_, F.col("n_records"))), F.lit(0)).alias("_staged"))
    done = F.sum("_staged").over(W.partitionBy(*by).orderBy("_slot"))
    at = parts.withColumn("staged", done).join(first.select(*by, "_n"), by)
    full = at.where((F.col("_slot") + 1) * interval <= F.col("_n")).select(*by, F.col("_slot").cast("int").alias("sequence"), ((F.col("_slot") + 1) * interval).alias("rows"), "staged", F.lit(False).alias("final"))
    last = at.groupBy(*by).agg(F.max_by("staged", "_slot").alias("staged"), F.max("_n").alias("rows"))
    return full.unionByName(last.select(*by, F.floor(F.col("rows") / interval).cast("int").alias("sequence"), "rows", "staged", F.lit(True).alias("final")))


def diverged(releases: DataFrame, identity: list[str], checksum: str, acquired: str) -> DataFrame:
    """Release identities that came with several checksums, with their number and first and last acquisition."""
    agg = releases.groupBy(*identity).agg(F.count_distinct(checksum).alias("n_checksums"), F.min(acquired).alias("first_acquired"), F.max(acquired).alias("last_acquired"))
    return agg.where("n_checksums > 1")


def key_profile(rows: DataFrame, key: Column) -> DataFrame:
    """One row: rows, rows without a key, distinct keys, keys of several rows, and the largest group."""
    groups = rows.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    named = F.col("k").isNotNull() & (F.col("k").cast("string") != "")
    return groups.agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("n_blank"), F.count_if(named).alias("n_keys"), F.count_if(named & (F.col("n") > 1)).alias("n_duplicated"), F.max(F.when(named, F.col("n"))).alias("largest"))


def distribution_drift(rows: DataFrame, column: str, release: str, baseline) -> DataFrame:
    """Share of each value in each release, against its share in the baseline release."""
    counts = rows.groupBy(release, column).agg(F.count("*").alias("n"))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(release)))
    base = shares.where(F.col(release) == baseline).select(column, F.col("share").alias("base_share"))
    return shares.where(F.col(release) != baseline).join(base, column, "left").withColumn("drift", F.col("share") - F.coalesce("base_share", F.lit(0.0)))


def count_drift(rows: DataFrame, by: list[str], period: str, tolerance: float) -> DataFrame:
    """Rows of each period against the period before: ratio, and whether it stays within tolerance."""
    counts = rows.groupBy(*by, period).agg(F.count("*").alias("n"))
    out = counts.withColumn("n_before", F.lag("n").over(W.partitionBy(*by).orderBy(period))).withColumn("ratio", F.col("n") / F.col("n_before"))
    return out.withColumn("passes", F.coalesce(F.abs(F.col("ratio") - 1) <= tolerance, F.lit(True)))


def evidence_manifest(rows: DataFrame, levels: list[str], fields: list[str]) -> DataFrame:
    """Record-free profile by rollup of levels: rows, and present values, least and greatest of each field, long."""
    aggs = [x for f in fields for x in (F.count(f).alias(f"{f}__n"), F.min(f).cast("double").alias(f"{f}__lo"), F.max(f).cast("double").alias(f"{f}__hi"))]
    wide = rows.rollup(*levels).agg(F.count("*").alias("n_rows"), *aggs)
    entries = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}__n").alias("n_present"), F.col(f"{f}__lo").alias("least"), F.col(f"{f}__hi").alias("greatest")) for f in fields)))
    return wide.select(*levels, "n_rows", entries.alias("e")).select(*levels, "n_rows", "e.*")


def reconciliation(rows: DataFrame, levels: list[str], value: str, official: DataFrame) -> DataFrame:
    """Counts and sums by rollup of levels, beside the official ones where there are any, and whether they agree."""
    ours = rows.rollup(*levels).agg(F.count("*").alias("n_rows"), F.sum(value).alias("total"))
    key = [ours[k].eqNullSafe(official[k]) for k in levels]
    met = ours.join(official, key, "left")
    return met.select(*(ours[k] for k in levels), "n_rows", "total", "official_rows", (F.col("n_rows") == F.col("official_rows")).alias("agrees"))


def evidence_seal(outcomes: DataFrame, entries: DataFrame, by: list[str], n: int = RETAINED) -> DataFrame:
    """outcomes (by, total, truncated, layout_fingerprint) against the entries kept: how many there should be, are, and
    name another layout than their outcome (none counts as another), and whether all agrees. Entries are counted by
    layout before they meet the outcomes."""
    kept = entries.groupBy(*by, F.col("layout_fingerprint").alias("_f")).agg(F.count("*").alias("_n"))
    met = outcomes.join(kept, by, "left")
    other = ~F.col("_f").eqNullSafe(F.col("layout_fingerprint"))
    met = met.groupBy(*outcomes.columns).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_kept"), F.coalesce(F.sum(F.when(other, F.col("_n"))), F.lit(0)).alias("n_disagreeing"))
    expected = F.least(F.col("total"), F.lit(n))
    agrees = (F.col("n_kept") == expected) & F.col("truncated").eqNullSafe(F.col("total") > n) & (F.col("n_disagreeing") == 0)
    return met.withColumn("expected", expected).withColumn("sealed", agrees)


def latest_per_key(releases: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first release of each key in the given order."""
    return releases.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_rank = 1").drop("_rank")


def lifecycle(events: DataFrame, entity: str, order: list[str], state: str, allowed: DataFrame) -> DataFrame:
    """Each entity's current state, changes, and changes that `allowed` (before, after) does not list."""
    w = W.partitionBy(entity).orderBy(*order)
    steps = events.withColumn("before", F.lag(state).over(w)).withColumn("after", F.col(state))
    legal = allowed.select("before", "after").distinct().withColumn("_ok", F.lit(True))
    met = steps.join(legal, ["before", "after"], "left")
    return met.groupBy(entity).agg(F.max_by("after", F.struct(*order)).alias("state"), F.count("before").alias("n_changes"), F.count_if(F.col("before").isNotNull() & F.col("_ok").isNull()).alias("n_illegal"))


def probe_outcome(observations: DataFrame, entity: str, order: list[str], signature: str, valid: Column) -> DataFrame:
    """Each observation against the last valid one before it; invalid ones are indeterminate and never become the baseline."""
    w = W.partitionBy(entity).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    base = observations.withColumn("baseline", F.last(F.when(valid, F.col(signature)), True).over(w))
    return base.withColumn("outcome", F.when(~valid, "indeterminate").when(F.col("baseline").isNull() | (F.col("baseline") != F.col(signature)), "changed").otherwise("no_probe_change"))


def verification_due(observations: DataFrame, entity: str, order: list[str], at: str, cadence: DataFrame) -> DataFrame:
    """Days since the observation before, against the days allowed in that season (cadence: first_month, last_month, days)."""
    w = W.partitionBy(entity).orderBy(*order)
    gaps = observations.withColumn("days", F.datediff(F.col(at), F.lag(at).over(w))).withColumn("_m", F.month(at))
    c = F.broadcast(cadence.withColumnRenamed("days", "allowed_days"))  # twelve rows at most: months don't overlap
    met = gaps.join(c, F.col("_m").between(F.col("first_month"), F.col("last_month")), "left").drop("_m", "first_month", "last_month")
    return met.withColumn("due", F.col("days") > F.col("allowed_days"))


def supersession(publications: DataFrame, key: list[str], ident: str, published: str) -> DataFrame:
    """Publications with who superseded them and when."""
    w = W.partitionBy(*key).orderBy(published, ident)
    return publications.withColumn("superseded_by", F.lead(ident).over(w)).withColumn("superseded_at", F.lead(published).over(w))


def freshness(publications: DataFrame, as_of: str, now: Column) -> DataFrame:
    """Age in days of each publication's source, and whether it is certified."""
    return publications.withColumn("age_days", F.datediff(now, F.col(as_of))).withColumn("is_certified", F.col("release_kind").startswith("certified"))


#: Modulus of evidence fingerprints, and that of the halves in which they are summed.
HALF = 1 << 64


def fingerprint_parts(columns: list[str]) -> tuple[Column, Column]:
    """A row's 128-bit hash by its values as text, as two numbers below 2^64; sums of them depend on no order."""
    row = F.to_json(F.struct(*(F.col(f"`{c}`").cast("string").alias(c) for c in sorted(columns))), {"ignoreNullFields": "false"})
    digest = F.sha2(row.cast("binary"), 256)
    return tuple(F.conv(F.substring(digest, i, 16), 16, 10).cast("decimal(38,0)") for i in (1, 17))


def fingerprinted(rows: DataFrame, levels: list[str], columns: list[str]) -> DataFrame:
    """(levels, n_rows, fingerprint) at the finest level: each half of the row hashes summed modulo 2^64, as 32 hex digits."""
    high, low = fingerprint_parts(columns)
    sums = rows.select(*levels, high.alias("_h"), low.alias("_l")).groupBy(*levels).agg(F.count("*").alias("n_rows"), F.sum("_h").alias("_h"), F.sum("_l").alias("_l"))
    return _shown(sums, levels)


def _shown(sums: DataFrame, levels: list[str]) -> DataFrame:
    """Sums of halves as hex digits. A sum of up to 2^62 halves of 64 bits stays below 38 digits."""
    half = lambda c: F.pmod(F.col(c), F.lit(str(HALF)).cast("decimal(38,0)"))
    text = lambda c: F.lpad(F.lower(F.conv(half(c).cast("decimal(20,0)").cast("string"), 10, 16)), 16, "0")
    return sums.select(*levels, "n_rows", F.concat(text("_h"), text("_l")).alias("fingerprint"))


def merged_fingerprints(evidence: DataFrame, levels: list[str]) -> DataFrame:
    """Upper levels (levels, n_rows, fingerprint) from fingerprints of a finer one alone, without its rows."""
    half = lambda i: F.conv(F.substring("fingerprint", i, 16), 16, 10).cast("decimal(38,0)")
    sums = evidence.select(*levels, "n_rows", half(1).alias("_h"), half(17).alias("_l")).groupBy(*levels).agg(F.sum("n_rows").alias("n_rows"), F.sum("_h").alias("_h"), F.sum("_l").alias("_l"))
    return _shown(sums, levels)


def keyed_evidence(rows: DataFrame, levels: list[str], key: list[str], columns: list[str]) -> DataFrame:
    """(levels, n_rows, n_keys, n_repeated, fingerprint) at every level of a rollup: keys, those of several rows, and the
    order-free fingerprint. Rows are summed by level and key once; all levels come from these sums."""
    high, low = fingerprint_parts(columns)
    by_key = rows.select(*levels, *key, high.alias("_h"), low.alias("_l")).groupBy(*levels, *key).agg(F.count("*").alias("_n"), F.sum("_h").alias("_h"), F.sum("_l").alias("_l"))
    up = by_key.rollup(*levels).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_keys"), F.count_if(F.col("_n") > 1).alias("n_repeated"), F.sum("_h").alias("_h"), F.sum("_l").alias("_l"))
    return _shown(up, [*levels, "n_keys", "n_repeated"]).select(*levels, "n_rows", "n_keys", "n_repeated", "fingerprint")
