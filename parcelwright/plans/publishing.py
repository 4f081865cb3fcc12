"""Quality rules, policies and products over the tables."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from parcelwright.operators import match, publish, reshape, rules as rules_table, versions
from parcelwright.plans.profiling import _RELEASES, releases
from parcelwright.plans.registry import query
from parcelwright.sources import views, workspace
from parcelwright.sources.views import accounts, money, table

A = views.ACCOUNTS_SQL

#: Rules whose failure blocks publication.
BLOCKING = (("over_range", 2), ("small_values", 1))

_EVAL = f"""{A}, m as (select county, tax_year, release_kind, -count(*) as a, count(*) filter (value is null) as b, count(*) filter (value > 499000) / count(*) as c, count(*) - count(distinct account_id) as d, count(distinct o_orderpriority) as e, avg(value::double) as f, count(*) filter (month(as_of) < 1) as g, count(*) filter (value < 2000) as h from accounts group by all),
ev as (select county, tax_year, release_kind, 'row_count' as rule_id, 1 as version, a::double as measured, -1.0::double as expected from m union all select county, tax_year, release_kind, 'missing_values', 1, b, 0 from m union all select county, tax_year, release_kind, 'over_range', 2, c, 0.005 from m union all select county, tax_year, release_kind, 'duplicate_accounts', 1, d, 0 from m
 union all select county, tax_year, release_kind, 'kinds', 1, e, 5 from m union all select county, tax_year, release_kind, 'mean_value', 3, f, 252000 from m union all select county, tax_year, release_kind, 'early_dates', 1, g, 0 from m union all select county, tax_year, release_kind, 'small_values', 1, h, 3 from m),
oc as (select county, tax_year, release_kind, max(as_of) as as_of, count(*) filter (o_orderkey % 4999 = 7) = 0 as accepted from accounts group by all),
pub as (select * from oc where accepted and not exists (select 1 from ev where ev.county = oc.county and ev.tax_year = oc.tax_year and ev.release_kind = oc.release_kind and measured > expected and rule_id in ('over_range', 'small_values'))),
rk as (select *, case release_kind when 'proposed' then 0 when 'certified' then 1 else 2 end as precedence from pub)"""
RUN = ["county", "tax_year", "release_kind"]


def rules():
    """Rules of the roll: (id, version, aggregate over account rows, most)."""
    return [
        ("row_count", 1, -F.count("*"), -1.0),
        ("missing_values", 1, F.count_if(F.col("value").isNull()), 0.0),
        ("over_range", 2, F.count_if(F.col("value") > 499000) / F.count("*"), 0.005),
        ("duplicate_accounts", 1, F.count("*") - F.count_distinct("account_id"), 0.0),
        ("kinds", 1, F.count_distinct("o_orderpriority"), 5.0),
        ("mean_value", 3, F.avg(F.col("value").cast("double")), 252000.0),
        ("early_dates", 1, F.count_if(F.month("as_of") < 1), 0.0),
        ("small_values", 1, F.count_if(F.col("value") < 2000), 3.0),
    ]


def evaluations(spark, sf_dir):
    return publish.evaluate_rules(accounts(spark, sf_dir), RUN, rules())


def outcomes(spark, sf_dir):
    return accounts(spark, sf_dir).groupBy(*RUN).agg(F.max("as_of").alias("as_of"), (F.count_if(F.col("o_orderkey") % 4999 == 7) == 0).alias("accepted"))


def publishable(spark, sf_dir):
    """Publishable runs with their as_of: outcomes and measures of runs come from one pass over accounts, written once."""
    mine = rules()
    severities = spark.createDataFrame([(r, v, "blocking" if (r, v) in BLOCKING else "warning") for r, v, _, _ in mine], "rule_id string, version int, severity string")
    profile = accounts(spark, sf_dir).groupBy(*RUN).agg(F.max("as_of").alias("as_of"), (F.count_if(F.col("o_orderkey") % 4999 == 7) == 0).alias("accepted"), *publish.rule_measures(mine))
    profile = workspace.written(profile, "runs")
    good = publish.publishable_runs(profile, match.blocking_failures(publish.evaluations_of(profile, RUN, mine), severities), RUN)
    return profile.select(*RUN, "as_of", "accepted").join(good, RUN, "left_semi")


@query("evaluate_rules", f"with {_EVAL} select county, tax_year, release_kind, rule_id, version, round(measured, 6) as measured, expected, coalesce(measured <= expected, false) as passed from ev")
def evaluate_rules(spark, sf_dir):
    return evaluations(spark, sf_dir).withColumn("measured", F.round("measured", 6))


@query(
    "evaluate_rule_table",
    f"""with {A}, r as (select county, tax_year, count(*) as n, count(*) filter (account_id is null) as missing, count(*) - count(distinct account_id) as repeats,
        count(*) filter (value < 2000 or value > 450000) / count(*) as outside, count(*) filter (not as_of >= date '1995-03-01') as early from accounts group by all),
      p as (select *, abs(n / lag(n) over (partition by county order by tax_year) - 1) as drift from r),
      c as (select county, tax_year, count(*) filter (l_partkey % 20 = 0) / count(*) as orphans from accounts join lineitem on l_orderkey = o_orderkey group by all),
      m as (select county, tax_year, count(*) filter (o_orderpriority = '1-URGENT') = 0 as absent from accounts group by all),
      v as (select county, tax_year, unnest(['key_present', 'key_unique', 'values_inside', 'values_inside', 'dates_late', 'count_drift', 'orphans', 'members', 'members', 'column_type']) as rule_id,
        unnest([1, 1, 2, 2, 1, 1, 1, 1, 1, 1]) as version, unnest(['account_id', null, 'value', 'o_custkey', null, null, 'land', '1-URGENT', 'nowhere', 'value decimal(18,2)']) as subject,
        unnest([missing::double, repeats::double, outside, 0.0, early::double, drift, orphans, absent::int::double, 1.0, 0.0]) as measured, unnest([0.0, 0.0, 0.02, 0.0, 0.0, 0.1, 0.05, 0.0, 0.0, 0.0]) as expected
        from p join c using (county, tax_year) join m using (county, tax_year))
    select county, tax_year, rule_id, version, subject, round(measured::double, 6) as measured, expected::double as expected, coalesce(measured <= expected, false) as passed from v""",
)
def evaluate_rule_table(spark, sf_dir):
    """All eight families over accounts by county and year, with rules, subjects and thresholds from a table; one rule is inactive, one superseded."""
    rows = [
        ("key_present", 1, "blocking", "required_key_completeness", "account_id", '{"most": 0}', True),
        ("key_unique", 1, "blocking", "logical_uniqueness", None, '{"most": 0}', True),
        ("values_inside", 1, "warning", "value_validity", "value", '{"most": 1, "low": 0}', True),
        ("values_inside", 2, "warning", "value_validity", "value", '{"most": 0.02, "low": 2000, "high": 450000}', True),
        ("values_inside", 2, "warning", "value_validity", "o_custkey", '{"most": 0, "low": 0}', True),
        ("dates_late", 1, "warning", "source_specific", None, '{"most": 0, "holds": "as_of >= date \'1995-03-01\'"}', True),
        ("count_drift", 1, "blocking", "record_count_drift", None, '{"most": 0.1}', True),
        ("orphans", 1, "blocking", "child_relationship", "land", '{"most": 0.05}', True),
        ("members", 1, "blocking", "archive_completeness", "1-URGENT", '{"most": 0}', True),
        ("members", 1, "blocking", "archive_completeness", "nowhere", '{"most": 0}', True),
        ("column_type", 1, "blocking", "schema_compatibility", "value decimal(18,2)", '{"most": 0}', True),
        ("retired", 1, "blocking", "source_specific", None, '{"most": 0, "holds": "false"}', False),
    ]
    a = accounts(spark, sf_dir)
    run = ["county", "tax_year"]
    counts = a.groupBy(*run).agg(F.count("*").alias("n"))
    previous = counts.withColumn("n_before", F.lag("n").over(W.partitionBy("county").orderBy("tax_year"))).drop("n")  # a row a county and year
    children = table(spark, sf_dir, "lineitem").join(a.select("o_orderkey", *run), F.col("l_orderkey") == F.col("o_orderkey")).select(*run, F.lit("land").alias("child_table"), (F.col("l_partkey") % 20 == 0).alias("orphaned"))
    members = a.select(*run, F.col("o_orderpriority").alias("member"))
    found = rules_table.evaluate(a, run, ["account_id"], spark.createDataFrame(rows, rules_table.RULES), previous, children, members)
    return found.withColumn("measured", F.round("measured", 6))


@query("run_publishable", f"with {_EVAL} select county, tax_year, release_kind from pub")
def run_publishable(spark, sf_dir):
    return publishable(spark, sf_dir).select(*RUN)


@query("release_gate", f"with {_EVAL} select account_id, a.county, a.value::double as value from accounts a join oc using (county, tax_year, release_kind) where accepted")
def release_gate(spark, sf_dir):
    return publish.accepted_records(accounts(spark, sf_dir), outcomes(spark, sf_dir), RUN).select("account_id", "county", F.col("value").cast("double").alias("value"))


@query("stage_duplicate_key", "with k as (select l_returnflag as run, l_orderkey, l_linenumber from lineitem group by all having count(*) > 1) select run, count(*) as n_keys, 'duplicate_record_key' as code from k group by 1")
def stage_duplicate_key(spark, sf_dir):
    return publish.stage_duplicates(table(spark, sf_dir, "lineitem").withColumn("run", F.col("l_returnflag")), ["run"], ["l_orderkey", "l_linenumber"])


@query("field_policy_projection", "select c_custkey, 'c_mktsegment' as source_field, c_mktsegment as lexical_text from customer")
def field_policy_projection(spark, sf_dir):
    policy = spark.createDataFrame(
        [("c_mktsegment", True, "reviewer", "2024-01-01", "R-1"), ("c_name", False, "reviewer", "2024-01-01", "R-2"), ("c_nationkey", True, "  ", "2024-01-01", "R-3")],
        "source_field string, publication_allowed boolean, approved_by string, approved_at string, review_reference string",
    )
    values = reshape.native_values(table(spark, sf_dir, "customer"), ["c_custkey"], {"c_name": "text", "c_mktsegment": "text", "c_nationkey": "integer"})
    return publish.publishable_fields(values, policy).select("c_custkey", "source_field", "lexical_text")


@query("protected_marker_suppression", "select c_custkey, case when c_custkey % 7 > 1 then c_name end as c_name, c_nationkey, cast(cast(c_acctbal as decimal(18,2)) as double) as c_acctbal from customer")
def protected_marker_suppression(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", money("c_acctbal").cast("double").alias("c_acctbal"))
    marker = F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_custkey") % 7 == 1)
    return publish.suppress_protected(c, marker, ["c_name"])


def shown(df):
    return df.select("account_id", *RUN, F.col("value").cast("double").alias("value"))


_WIN = "qualify row_number() over (partition by county order by tax_year desc, precedence desc, as_of desc) = 1"


@query("latest_available", f"with {_EVAL}, w as (select * from rk {_WIN}) select account_id, county, tax_year, release_kind, a.value::double as value from accounts a join w using (county, tax_year, release_kind)")
def latest_available(spark, sf_dir):
    return shown(publish.product(accounts(spark, sf_dir), publishable(spark, sf_dir)))


@query("latest_certified", f"with {_EVAL}, w as (select * from rk where release_kind <> 'proposed' {_WIN}) select account_id, county, tax_year, release_kind, a.value::double as value from accounts a join w using (county, tax_year, release_kind)")
def latest_certified(spark, sf_dir):
    return shown(publish.product(accounts(spark, sf_dir), publishable(spark, sf_dir), ["certified", "certified-with-supplemental"]))


@query("history_product", f"with {_EVAL} select account_id, county, tax_year, release_kind, a.value::double as value from accounts a join pub using (county, tax_year, release_kind)")
def history_product(spark, sf_dir):
    return shown(publish.history_product(accounts(spark, sf_dir), publishable(spark, sf_dir)))


_PROMOTED = f"{_RELEASES}, b as (select county, tax_year, release_kind, as_of, case when n % 5 = 0 then 'failed' else 'built' end as st from rel), pr as (select county, tax_year, release_kind, as_of, case when st = 'failed' then 'failed' when row_number() over (partition by county, release_kind, st order by tax_year desc, as_of desc) = 1 then 'current' else 'superseded' end as state from b)"


def promoted(spark, sf_dir):
    built = releases(spark, sf_dir).select(*RUN, "as_of", F.when(F.col("n") % 5 == 0, "failed").otherwise("built").alias("state"))
    return publish.promote(built, ["county", "release_kind"], [F.desc("tax_year"), F.desc("as_of")])


@query("promote_publication", f"with {_PROMOTED} select * from pr")
def promote_publication(spark, sf_dir):
    return promoted(spark, sf_dir)


@query(
    "publication_versions",
    """with b as (select o_custkey % 40 as county, 1 as round, count(*) as n, sum(cast(o_totalprice as decimal(18,2))) as total from orders where o_orderkey % 2 = 0 group by 1
        union all select o_custkey % 40, 2, count(*), sum(cast(o_totalprice as decimal(18,2))) from orders group by 1),
      j as (select *, case when round = 1 and county % 7 = 0 or round = 2 and (county % 3 = 0 or county % 5 = 0) then 'failed' else 'good' end as st from b),
      p as (select *, st = 'good' and round = max(round) filter (st = 'good') over (partition by county) as cur from j)
    select cast(county as varchar) as county, round::long as version, case when st = 'failed' then 'failed' when cur then 'current' else 'superseded' end as state,
      case when st = 'good' and not cur then county + 2000 end as superseded_by, case when cur then n else 0 end as n_rows, case when cur then total::double else 0 end as total from p""",
)
def publication_versions(spark, sf_dir):
    """Two promotions of a product for forty counties. In each some builds fail and some have runs that are not publishable; their counties keep what they had."""
    a = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("c"), "o_orderkey", money("o_totalprice").alias("value"))
    store = versions.Publications(spark, workspace.new_path(spark, "publications"))
    records = a.select(F.lit("roll").alias("product"), F.col("c").cast("string").alias("county"), "o_orderkey", "value", F.explode(F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))).alias("round"), "c")
    records = records.withColumn("run", F.col("c") + F.col("round") * 1000)
    for number in (1, 2):
        mine = records.where(F.col("round") == number)
        failed = (F.col("c") % 7 == 0) if number == 1 else (F.col("c") % 3 == 0)
        builds = mine.groupBy("product", "county", "run", "c").count().select("product", "county", "run", F.col("run").alias("publication"), F.when(failed, "failed").otherwise("built").alias("state"), F.lit(f"2025-0{number}-01").cast("timestamp").alias("published_at"), "c")
        blocked = (F.col("c") % 5 == 0) & (F.lit(number) == 2)
        store.promote(builds.drop("c"), mine.drop("round", "c"), builds.where(~blocked).select("run"))
    seen = store.read("product string, county string, o_orderkey long, value decimal(18,2)").groupBy("county", "version").agg(F.count("*").alias("n_rows"), F.sum("value").cast("double").alias("total"))
    met = store.table().join(seen, ["county", "version"], "left")
    shown_ = F.col("state") == "current"
    return met.select("county", "version", "state", "superseded_by", F.when(shown_, F.col("n_rows")).otherwise(0).alias("n_rows"), F.when(shown_, F.col("total")).otherwise(0.0).alias("total"))


@query("current_publication", f"with {_PROMOTED} select county, tax_year, release_kind, as_of from pr where state = 'current'")
def current_publication(spark, sf_dir):
    return publish.current_publication(promoted(spark, sf_dir))


@query("account_lookup", f"with {_EVAL} select account_id, county, tax_year, release_kind, value::double as value from accounts where county = 3 and account_id = (select min(account_id) from accounts where county = 3)")
def account_lookup(spark, sf_dir):
    a = accounts(spark, sf_dir)
    folder = workspace.new_path(spark, "gold")
    publish.write_lookup(a, folder)
    gold = spark.read.schema(a.schema).parquet(folder)
    first = gold.where("county = 3").agg(F.min("account_id").alias("account_id")).first()[0]
    return shown(publish.account_lookup(gold, 3, F.lit(first)))


@query(
    "account_fields",
    """with a as (select lpad(cast(o_orderkey as varchar), 17, '0') as account_id, o_custkey % 6 as county, o_orderkey, cast(o_totalprice as decimal(18,2)) as value, year(o_orderdate) as run from orders)
    select account_id, source_field, v as value, run, 'release-' || run as release from (select account_id, run, unnest(['value', 'run']) as source_field, unnest([cast(value as varchar), cast(run as varchar)]) as v from a where county = 3 and o_orderkey % 50 = 1)""",
)
def account_fields(spark, sf_dir):
    """Approved fields and lineage of some accounts of a county, from a table laid out for look-up; the name of the customer is not approved."""
    o = table(spark, sf_dir, "orders")
    a = o.select(F.lpad(F.col("o_orderkey").cast("string"), 17, "0").alias("account_id"), (F.col("o_custkey") % 6).cast("int").alias("county"), money("o_totalprice").alias("value"), F.year("o_orderdate").alias("run"), F.col("o_clerk" if "o_clerk" in o.columns else "o_orderpriority").alias("owner"), "o_orderkey")
    folder = workspace.new_path(spark, "gold")
    publish.write_lookup(a.drop("o_orderkey"), folder, rows_per_file=2_000, rows_per_group=500)
    gold = spark.read.schema(a.drop("o_orderkey").schema).parquet(folder)
    wanted = [r.account_id for r in a.where((F.col("county") == 3) & (F.col("o_orderkey") % 50 == 1)).select("account_id").collect()]  # the accounts that a caller asks for
    when = F.lit("2025-01-01").cast("timestamp")
    policy = spark.createDataFrame([("value", True, "A. Clerk", "R-1"), ("run", True, "A. Clerk", "R-2"), ("owner", False, "A. Clerk", "R-3")], "source_field string, publication_allowed boolean, approved_by string, review_reference string").withColumn("approved_at", when)
    lineage = a.select("run").distinct().withColumn("release", F.concat(F.lit("release-"), F.col("run").cast("string")))
    return publish.lookup(gold, 3, wanted, ["value", "run", "owner"], policy, lineage).select("account_id", "source_field", "value", "run", "release")
