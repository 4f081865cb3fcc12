"""Release accounting, profiles and windows over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwright.operators import release
from parcelwright.plans.registry import query
from parcelwright.plans.validating import judged
from parcelwright.sources import scan, views, workspace
from parcelwright.sources.views import accounts, counties, members, observations, owner_rows, table

A, O, M, V = views.ACCOUNTS_SQL, views.OWNER_ROWS_SQL, views.MEMBERS_SQL, views.OBSERVATIONS_SQL
_DIAGS = "list_filter([case when o_orderkey % 97 = 0 then 'invalid_account_id' end, case when tax_year not between 1996 and 2000 then 'invalid_tax_year' end, case when value > 400000 then 'out_of_range' end], lambda x: x is not null)"


def rolls(spark, sf_dir):
    """Judged account rows with their key as the physical row number; the years in range only have value rejects."""
    return judged(spark, sf_dir).withColumn("physical_row_number", F.col("o_orderkey"))


def small_rolls(spark, sf_dir):
    """Releases by customer, so that some are free of rejects."""
    return rolls(spark, sf_dir).withColumn("release", F.col("o_custkey"))


@query(
    "release_outcome",
    f"""with {A}, d as (select o_custkey as release, o_orderkey as rn, len({_DIAGS}) as n from accounts), f as (select *, min(rn) filter (n > 0) over (partition by release) as first_rejected from d)
    select release, count(*) as n_rows, count(*) filter (n > 0) as n_rejected, sum(n)::bigint as n_diagnostics, min(first_rejected) as first_rejected, count(*) filter (first_rejected is null or rn < first_rejected) as n_staged,
    count(*) filter (n > 0) = 0 as accepted, case when count(*) filter (n > 0) = 0 then count(*) else 0 end as n_committed, case when count(*) filter (n > 0) = 0 then 'accepted' else 'record_rejected' end as disposition from f group by release""",
)
def release_outcome(spark, sf_dir):
    return release.release_outcome(small_rolls(spark, sf_dir), ["release"])


@query("diverged_release", f"with {A} select county, tax_year, release_kind, count(distinct o_orderpriority) as n_checksums, min(as_of) as first_acquired, max(as_of) as last_acquired from accounts group by all having count(distinct o_orderpriority) > 1")
def diverged_release(spark, sf_dir):
    return release.diverged(accounts(spark, sf_dir), ["county", "tax_year", "release_kind"], "o_orderpriority", "as_of")


@query("key_profile", "with g as (select case when l_orderkey % 13 = 0 then null else l_orderkey * 10 + l_linenumber end as k, count(*) as n from lineitem group by 1) select sum(n)::bigint as n_rows, coalesce(sum(n) filter (k is null), 0)::bigint as n_blank, count(k) as n_keys, count(*) filter (k is not null and n > 1) as n_duplicated, max(n) filter (k is not null) as largest from g")
def key_profile(spark, sf_dir):
    key = F.when(F.col("l_orderkey") % 13 == 0, None).otherwise(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return release.key_profile(table(spark, sf_dir, "lineitem"), key)


@query(
    "distribution_drift",
    f"with {A}, c as (select tax_year, release_kind, count(*) as n from accounts group by all), s as (select *, n / sum(n) over (partition by tax_year) as share from c) select s.tax_year, s.release_kind, s.n, s.share, b.share as base_share, s.share - coalesce(b.share, 0) as drift from s left join (select * from s where tax_year = 1995) b using (release_kind) where s.tax_year <> 1995",
)
def distribution_drift(spark, sf_dir):
    return release.distribution_drift(accounts(spark, sf_dir), "release_kind", "tax_year", 1995)


@query("record_count_drift", f"with {A}, c as (select county, tax_year, count(*) as n from accounts group by all), l as (select *, lag(n) over (partition by county order by tax_year) as n_before from c) select *, n / n_before as ratio, coalesce(abs(n / n_before - 1) <= 0.1, true) as passes from l")
def record_count_drift(spark, sf_dir):
    return release.count_drift(accounts(spark, sf_dir), ["county"], "tax_year", 0.1)


@query(
    "evidence_manifest",
    f"""with {A}, w as (select county, tax_year, count(*) as n_rows, count(value) as a, min(value)::double as b, max(value)::double as c, count(o_custkey) as d, min(o_custkey)::double as e, max(o_custkey)::double as f from accounts group by rollup (county, tax_year))
    select county, tax_year, n_rows, 'value' as field, a as n_present, b as least, c as greatest from w union all select county, tax_year, n_rows, 'o_custkey', d, e, f from w""",
)
def evidence_manifest(spark, sf_dir):
    return release.evidence_manifest(accounts(spark, sf_dir), ["county", "tax_year"], ["value", "o_custkey"])


_HALF = lambda i: f"(sum(cast('0x' || substr(sha, {i}, 16) as uhugeint)::hugeint) % 18446744073709551616)"


@query(
    "evidence_fingerprint",
    f"""with {A}, r as (select county, tax_year, o_custkey, sha256('{{"o_custkey":"' || o_custkey || '","o_orderkey":"' || o_orderkey || '","value":"' || value || '"}}') as sha from accounts),
      k as (select county, tax_year, o_custkey, count(*) as n from r group by all),
      f as (select county, tax_year, count(*) as n_rows, lpad(to_hex({_HALF(1)}::ubigint), 16, '0') || lpad(to_hex({_HALF(17)}::ubigint), 16, '0') as fingerprint from r group by rollup (county, tax_year)),
      g as (select county, tax_year, count(*) as n_keys, count(*) filter (n > 1) as n_repeated from k group by rollup (county, tax_year))
    select f.county, f.tax_year, n_rows, n_keys, n_repeated, lower(fingerprint) as fingerprint, true as merges from f join g on f.county is not distinct from g.county and f.tax_year is not distinct from g.tax_year""",
)
def evidence_fingerprint(spark, sf_dir):
    """Keys and order-free fingerprints at all levels; those of counties and of all must equal what merges from the years' fingerprints."""
    a = workspace.written(accounts(spark, sf_dir).select("county", "tax_year", "o_custkey", "o_orderkey", "value"), "evidence")
    columns = ["o_custkey", "o_orderkey", "value"]
    made = release.keyed_evidence(a, ["county", "tax_year"], ["o_custkey"], columns)
    fine = release.fingerprinted(a, ["county", "tax_year"], columns)
    up = release.merged_fingerprints(fine, ["county"]).withColumn("tax_year", F.lit(None).cast("int"))
    whole = release.merged_fingerprints(fine, []).withColumns({"county": F.lit(None).cast("int"), "tax_year": F.lit(None).cast("int")})
    merged = fine.unionByName(up).unionByName(whole).select(F.col("county").alias("_c"), F.col("tax_year").alias("_y"), F.col("fingerprint").alias("_f"))
    met = made.join(merged, made["county"].eqNullSafe(F.col("_c")) & made["tax_year"].eqNullSafe(F.col("_y")), "left")
    return met.select("county", "tax_year", "n_rows", "n_keys", "n_repeated", "fingerprint", F.coalesce(F.col("_f") == F.col("fingerprint"), F.lit(False)).alias("merges"))


@query(
    "county_reconciliation",
    f"with {A}, c as (select county, tax_year, count(*) as n_rows, sum(value)::double as total from accounts group by rollup (county, tax_year)), f as (select county, tax_year, count(*) + (case when tax_year = 1997 then 1 else 0 end) as official_rows from accounts group by county, tax_year) select c.*, f.official_rows, n_rows = official_rows as agrees from c left join f on c.county is not distinct from f.county and c.tax_year is not distinct from f.tax_year",
)
def county_reconciliation(spark, sf_dir):
    a = accounts(spark, sf_dir)
    official = a.groupBy("county", "tax_year").agg((F.count("*") + F.when(F.col("tax_year") == 1997, 1).otherwise(0)).alias("official_rows"))
    return release.reconciliation(a, ["county", "tax_year"], "value", official).withColumn("total", F.col("total").cast("double"))


@query(
    "cohort_readiness",
    f"with {A}, {views.COUNTIES_SQL}, y as (select distinct tax_year from accounts), r as (select distinct county, tax_year from accounts group by all having max(value) > 400000) select tax_year, bool_and(r.county is not null) as ready, coalesce(string_agg(slug, ',' order by slug) filter (r.county is null), '') as missing from y cross join counties c left join r using (county, tax_year) group by 1",
)
def cohort_readiness(spark, sf_dir):
    a = accounts(spark, sf_dir)
    done = a.groupBy("county", "tax_year").agg(F.max("value").alias("most")).where("most > 400000").select("county", "tax_year", F.lit(True).alias("ok"))
    all_ = a.select("tax_year").distinct().crossJoin(F.broadcast(counties(spark)))  # six rows
    met = all_.join(done, ["county", "tax_year"], "left")
    return met.groupBy("tax_year").agg(F.every(F.col("ok").isNotNull()).alias("ready"), F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("ok").isNull(), F.col("slug"))))).alias("missing"))


@query("member_size_summary", f"with {M} select archive, count(*) as n_members, sum(declared)::bigint as expanded, sum(compressed)::bigint as compressed, case when sum(compressed) = 0 then case when sum(declared) = 0 then 1.0 else 'inf'::double end else sum(declared) / sum(compressed) end as ratio from members group by 1")
def member_size_summary(spark, sf_dir):
    s = members(spark, sf_dir).groupBy("archive").agg(F.count("*").alias("n_members"), F.sum("declared").alias("expanded"), F.sum("compressed").alias("compressed"))
    ratio = F.when(F.col("compressed") == 0, F.when(F.col("expanded") == 0, 1.0).otherwise(float("inf"))).otherwise(F.try_divide("expanded", "compressed"))
    return s.withColumn("ratio", ratio)


@query(
    "progress_table",
    "with c as (select l_returnflag as release, count(*) as n from lineitem group by 1), p as (select release, unnest(list_append(list_transform(range(1, n // 1000 + 1), lambda i: i * 1000), n)) as rows, generate_subscripts(list_append(list_transform(range(1, n // 1000 + 1), lambda i: i * 1000), n), 1) - 1 as sequence from c) select release, sequence::int as sequence, rows from p",
)
def progress_table(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("release")).agg(F.count("*").alias("n_rows"))
    return release.progress(counts, ["release"], 1000)


@query(
    "staged_progress",
    """with r as (select l_returnflag as release, row_number() over (partition by l_returnflag order by l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus) as rn, l_orderkey % 3 as n, l_returnflag <> 'N' and l_orderkey % 997 = 990 as bad from lineitem),
      c as (select release, rn, sum(case when f is null or rn < f then n else 0 end) over (partition by release order by rn) as staged, max(rn) over (partition by release) as last from r join (select release, min(rn) filter (bad) as f from r group by 1) using (release))
    select release, (rn // 1000 - 1)::int as sequence, rn as rows, staged::bigint as staged, false as final from c where rn % 1000 = 0 union all select release, (rn // 1000)::int, rn, staged::bigint, true from c where rn = last""",
)
def staged_progress(spark, sf_dir):
    """Lines of each return flag as a release; rows of an order make none to two records, and the first rejected row ends staging."""
    li = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
    part = F.col("l_returnflag").alias("member"), F.struct(*order).alias("value")
    sorted_ = li.repartitionByRange("l_returnflag", *order).sortWithinPartitions("l_returnflag", *order).select(*part).withColumn("block", F.spark_partition_id())
    numbered = scan.with_row_numbers(sorted_)
    rows = numbered.select(F.col("member").alias("release"), "physical_row_number", (F.col("value.l_orderkey") % 3).alias("n_records"), ((F.col("member") != "N") & (F.col("value.l_orderkey") % 997 == 990)).alias("rejected"))
    return release.staged_progress(rows, ["release"], 1000)


@query(
    "evidence_seal",
    """with e as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as rn, count(*) over (partition by user_id) as total from events where event_type = 'error'),
    k as (select user_id, any_value(total) as total, any_value(total) > 100 as truncated, 'f' || user_id % 3 as layout_fingerprint, count(*) filter (rn <= 100 and event_id % 50 <> 3) as n_kept, count(*) filter (rn <= 100 and event_id % 50 <> 3 and event_id % 7 = 0) as n_disagreeing from e group by user_id)
    select *, least(total, 100) as expected, n_kept = least(total, 100) and n_disagreeing = 0 as sealed from k""",
)
def evidence_seal(spark, sf_dir):
    layout = F.concat(F.lit("f"), (F.col("user_id") % 3).cast("string")).alias("layout_fingerprint")
    errors = table(spark, sf_dir, "events").where("event_type = 'error'").select("user_id", "event_id", "ts", F.when(F.col("event_id") % 7 > 0, layout).alias("layout_fingerprint"))
    kept = release.retain(errors, ["user_id"], ["ts", "event_id"]).where("event_id % 50 <> 3")
    outcomes = errors.groupBy("user_id").agg(F.count("*").alias("total")).select("user_id", "total", (F.col("total") > release.RETAINED).alias("truncated"), layout)
    return release.evidence_seal(outcomes, kept, ["user_id"])


@query("diagnostics_top100", "select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as ordinal, count(*) over (partition by user_id) as total, count(*) over (partition by user_id) > 100 as truncated from events qualify row_number() over (partition by user_id order by ts, event_id) <= 100")
def diagnostics_top100(spark, sf_dir):
    return release.retain(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("notices_cap", "select event_type, event_id, row_number() over (partition by event_type order by user_id, event_id) as ordinal, count(*) over (partition by event_type) as total, count(*) over (partition by event_type) > 100 as truncated from events qualify row_number() over (partition by event_type order by user_id, event_id) <= 100")
def notices_cap(spark, sf_dir):
    return release.retain(table(spark, sf_dir, "events").select("event_type", "event_id", "user_id"), ["event_type"], ["user_id", "event_id"]).drop("user_id")


_RELEASES = f"{A}, rel as (select county, tax_year, release_kind, max(as_of) as as_of, count(*) as n, case release_kind when 'proposed' then 0 when 'certified' then 1 else 2 end as precedence from accounts group by all)"


def releases(spark, sf_dir):
    r = accounts(spark, sf_dir).groupBy("county", "tax_year", "release_kind").agg(F.max("as_of").alias("as_of"), F.count("*").alias("n"))
    return r.withColumn("precedence", F.when(F.col("release_kind") == "proposed", 0).when(F.col("release_kind") == "certified", 1).otherwise(2))


@query("latest_per_key", f"with {_RELEASES} select county, tax_year, release_kind, as_of, n from rel qualify row_number() over (partition by county order by tax_year desc, precedence desc, as_of desc) = 1")
def latest_per_key(spark, sf_dir):
    return release.latest_per_key(releases(spark, sf_dir), ["county"], [F.desc("tax_year"), F.desc("precedence"), F.desc("as_of")]).drop("precedence")


ALLOWED = (("signup", "view"), ("view", "click"), ("click", "purchase"), ("view", "view"), ("click", "view"), ("purchase", "view"))


@query(
    "lifecycle_state",
    "with s as (select *, lag(event_type) over (partition by user_id order by ts, event_id) as before from events) select user_id, arg_max(event_type, struct_pack(a := ts, b := event_id)) as state, count(before) as n_changes, count(*) filter (before is not null and (before, event_type) not in (" + ", ".join(f"('{a}', '{b}')" for a, b in ALLOWED) + ")) as n_illegal from s group by 1",
)
def lifecycle_state(spark, sf_dir):
    return release.lifecycle(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type", spark.createDataFrame(ALLOWED, "before string, after string"))


@query(
    "probe_outcome",
    f"with {V}, b as (select *, last_value(case when valid then signature end ignore nulls) over (partition by entity order by ts, event_id rows between unbounded preceding and 1 preceding) as baseline from observations) select event_id, baseline, case when not valid then 'indeterminate' when baseline is null or baseline <> signature then 'changed' else 'no_probe_change' end as outcome from b",
)
def probe_outcome(spark, sf_dir):
    return release.probe_outcome(observations(spark, sf_dir), "entity", ["ts", "event_id"], "signature", F.col("valid")).select("event_id", "baseline", "outcome")


@query(
    "verification_due",
    "with g as (select event_id, date_diff('day', lag(ts::date) over (partition by user_id order by ts, event_id), ts::date)::int as days, month(ts) as m from events) select event_id, days, case when m <= 3 then 1 when m <= 9 then 2 else 30 end::int as allowed_days, days > case when m <= 3 then 1 when m <= 9 then 2 else 30 end as due from g",
)
def verification_due(spark, sf_dir):
    cadence = spark.createDataFrame([(1, 3, 1), (4, 9, 2), (10, 12, 30)], "first_month int, last_month int, days int")
    return release.verification_due(observations(spark, sf_dir), "entity", ["ts", "event_id"], "ts", cadence).select("event_id", "days", "allowed_days", "due")


@query("supersession_chain", f"with {_RELEASES} select county, release_kind, tax_year, lead(tax_year) over (partition by county, release_kind order by as_of, tax_year) as superseded_by, lead(as_of) over (partition by county, release_kind order by as_of, tax_year) as superseded_at from rel")
def supersession_chain(spark, sf_dir):
    """Publications, one row a release: all rows of the roll make them, by partial sums, and only they are windowed."""
    return release.supersession(releases(spark, sf_dir), ["county", "release_kind"], "tax_year", "as_of").select("county", "release_kind", "tax_year", "superseded_by", "superseded_at")


@query("freshness", f"with {_RELEASES} select county, tax_year, release_kind, as_of, date_diff('day', as_of, date '2002-01-01')::int as age_days, release_kind <> 'proposed' as is_certified from rel")
def freshness(spark, sf_dir):
    return release.freshness(releases(spark, sf_dir), "as_of", F.lit("2002-01-01").cast("date")).drop("n", "precedence")
