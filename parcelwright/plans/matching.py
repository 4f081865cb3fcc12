"""Reconciliation, matching and snapshot comparison over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwright.operators import match, release
from parcelwright.plans.profiling import _RELEASES, releases
from parcelwright.plans.registry import query
from parcelwright.sources import views
from parcelwright.sources.views import accounts, table

A = views.ACCOUNTS_SQL


@query(
    "bronze_classify",
    f"""with {A}, c as (select o_custkey as p, o_orderpriority as sha, o_orderkey from accounts where o_orderkey % 2 = 0), r as (select o_custkey as p, o_orderpriority as sha from accounts where o_orderkey % 2 = 1), k as (select p, count(distinct sha) as n from r group by 1)
    select c.o_orderkey, case when k.n is null then 'NEW' when k.n > 1 or not exists (select 1 from r where r.p = c.p and r.sha = c.sha) then 'DIVERGED' else 'IDENTICAL' end as classification from c left join k using (p)""",
)
def bronze_classify(spark, sf_dir):
    """Every order is a candidate or a reference."""
    a = accounts(spark, sf_dir).select(F.col("o_custkey").alias("p"), F.col("o_orderpriority").alias("sha"), "o_orderkey")
    return match.classify_artifacts(a.where("o_orderkey % 2 = 0"), a.where("o_orderkey % 2 = 1"), ["p"], "sha").select("o_orderkey", "classification")


@query("dangling_reference", "select l_orderkey, l_linenumber, l_partkey, case when p_partkey is null then 'missing_artifact' else 'p_size_mismatch' end as code from lineitem left join (select * from part where p_partkey % 10 > 0) on l_partkey = p_partkey where p_partkey is null or cast(l_quantity as int) <> p_size")
def dangling_reference(spark, sf_dir):
    refs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").alias("k"), F.col("l_quantity").cast("int").alias("size"))
    parts = table(spark, sf_dir, "part").where("p_partkey % 10 > 0").withColumn("k", F.col("p_partkey"))
    return match.dangling_references(refs, parts, "k", {"size": "p_size"}).drop("k", "size")


@query("manifest_lineage", "select r_name, n_name, count(*) as n_records, count(distinct o_orderkey) as n_runs, count(distinct c_custkey) as n_manifests from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by all")
def manifest_lineage(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    o, c = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    trace = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    small = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    met = trace.join(small, F.col("c_nationkey") == F.col("n_nationkey"))
    return met.groupBy("r_name", "n_name").agg(F.sum("n").alias("n_records"), F.count_distinct("o_orderkey").alias("n_runs"), F.count_distinct("c_custkey").alias("n_manifests"))


@query("blocking_failure", "select o_orderkey as run, 'rule' || o_custkey % 4 as rule_id, 1 + o_orderkey % 2 as version from orders where o_orderstatus = 'F' and (o_custkey % 4, 1 + o_orderkey % 2) in ((0, 1), (1, 2), (3, 1))")
def blocking_failure(spark, sf_dir):
    rules = spark.createDataFrame([("rule0", 1, "blocking"), ("rule0", 2, "warning"), ("rule1", 2, "blocking"), ("rule3", 1, "blocking"), ("rule2", 1, "warning")], "rule_id string, version long, severity string")
    e = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), F.concat(F.lit("rule"), (F.col("o_custkey") % 4).cast("string")).alias("rule_id"), (1 + F.col("o_orderkey") % 2).alias("version"), (F.col("o_orderstatus") != "F").alias("passed"))
    return match.blocking_failures(e, rules).select("run", "rule_id", "version")


_MATCH_SQL = """acc as (select c_custkey, c_nationkey as county, c_custkey % 1000 as account, case when c_custkey % 9 > 0 then cast(round(c_acctbal / 100) as bigint) end as address from customer), prop as (select s_suppkey, s_nationkey as county, s_suppkey % 1000 as account, cast(round(s_acctbal / 100) as bigint) as address from supplier),
ex as (select c_custkey, s_suppkey from acc join prop on acc.county = prop.county and acc.account = prop.account)"""


def sides(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("county"), (F.col("c_custkey") % 1000).alias("account"), F.when(F.col("c_custkey") % 9 == 0, " . ").otherwise(F.format_string("  No. %d, Main  st.", (F.round(F.col("c_acctbal") / 100) + 100).cast("long"))).alias("address"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("county"), (F.col("s_suppkey") % 1000).alias("account"), F.format_string("no %d MAIN-ST", (F.round(F.col("s_acctbal") / 100) + 100).cast("long")).alias("address"))
    exact = match.exact_match(c.drop("address"), s.drop("address"), ["county", "account"])
    return c, s, exact


@query("exact_property_match", f"with {_MATCH_SQL} select c_custkey, s_suppkey, 'exact' as method, 1.0::double as confidence from ex")
def exact_property_match(spark, sf_dir):
    return sides(spark, sf_dir)[2].select("c_custkey", "s_suppkey", "method", "confidence")


@query("candidate_property_match", f"with {_MATCH_SQL} select c_custkey, s_suppkey, 'exact' as method, 1.0::double as confidence from ex union all select c_custkey, s_suppkey, 'candidate', 0.5 from acc join prop on acc.county = prop.county and acc.address = prop.address where c_custkey not in (select c_custkey from ex)")
def candidate_property_match(spark, sf_dir):
    c, s, exact = sides(spark, sf_dir)
    candidates = match.candidate_match(c.drop("account"), s.drop("account"), exact, "c_custkey", "county", "address")
    names = ["c_custkey", "s_suppkey", "method", "confidence"]
    return exact.select(*names).unionByName(candidates.select(*names))


@query(
    "bounded_property_match",
    """with a as (select c_custkey, c_nationkey as county, case when c_custkey % 2 = 0 then 1000000 else cast(round(c_acctbal / 100) as bigint) end as address from customer),
      p as (select s_suppkey, s_nationkey as county, case when s_suppkey % 2 = 0 then 1000000 else cast(round(s_acctbal / 100) as bigint) end as address from supplier),
      ex as (select c_custkey from a join p on a.county = p.county and c_custkey % 1000 = s_suppkey % 1000), o as (select * from a where c_custkey not in (select c_custkey from ex)),
      b as (select county, address, x.n as n_accounts, y.n as n_properties from (select county, address, count(*) as n from o group by all) x join (select county, address, count(*) as n from p group by all) y using (county, address))
    select 'pair' as kind, cast(c_custkey as varchar) as account, cast(s_suppkey as varchar) as property, 1 as n_accounts, 1 as n_properties from o join p using (county, address) join b using (county, address) where b.n_accounts * b.n_properties <= 100
    union all select 'class', cast(c_custkey as varchar), null, n_accounts, n_properties from o join b using (county, address) where n_accounts * n_properties > 100
    union all select 'class', null, cast(s_suppkey as varchar), n_accounts, n_properties from p join b using (county, address) where n_accounts * n_properties > 100""",
)
def bounded_property_match(spark, sf_dir):
    """Candidates where half of each county's accounts and properties share one address: that address is a class, not all pairs."""
    spelled = lambda key, balance, form: F.when(F.col(key) % 2 == 0, F.lit("PO Box 1")).otherwise(F.format_string(form, (F.round(F.col(balance) / 100) + 100).cast("long")))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("county"), (F.col("c_custkey") % 1000).alias("account"), spelled("c_custkey", "c_acctbal", "  No. %d, Main  st.").alias("address"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("county"), (F.col("s_suppkey") % 1000).alias("account"), spelled("s_suppkey", "s_acctbal", "no %d MAIN-ST").alias("address"))
    exact = match.exact_match(c.drop("address"), s.drop("address"), ["county", "account"])
    pairs, classes = match.bounded_candidates(c.drop("account"), s.drop("account"), exact, "c_custkey", "s_suppkey", "county", "address")
    one = F.lit(1).cast("long")
    shown = pairs.select(F.lit("pair").alias("kind"), F.col("c_custkey").cast("string").alias("account"), F.col("s_suppkey").cast("string").alias("property"), one.alias("n_accounts"), one.alias("n_properties"))
    is_account = F.col("side") == "account"
    return shown.unionByName(classes.select(F.lit("class").alias("kind"), F.when(is_account, F.col("key")).alias("account"), F.when(~is_account, F.col("key")).alias("property"), "n_accounts", "n_properties"))


@query(
    "snapshot_diff",
    """with o as (select case when o_custkey % 10 > 0 then o_orderkey // 2 else -o_orderkey end as k, o_orderstatus, o_custkey % 3 as f from orders where o_orderkey % 2 = 0), n as (select case when o_custkey % 10 < 9 then o_orderkey // 2 else -o_orderkey end as k, o_orderstatus, o_custkey % 3 as f from orders where o_orderkey % 2 = 1)
    select coalesce(o.k, n.k) as k, case when o.k is null then 'added' when n.k is null then 'removed' when o.o_orderstatus = n.o_orderstatus and o.f = n.f then 'retained' else 'changed' end as change from o full join n on o.k = n.k""",
)
def snapshot_diff(spark, sf_dir):
    """Orders of even and of odd number as two releases that share most keys; the keys of some stand in one of them alone. Every order is in one side."""
    own = F.expr("case when o_orderkey % 2 = 0 and o_custkey % 10 = 0 or o_orderkey % 2 = 1 and o_custkey % 10 = 9 then -o_orderkey else o_orderkey div 2 end")
    o = table(spark, sf_dir, "orders").select(own.alias("k"), "o_orderstatus", (F.col("o_custkey") % 3).alias("f"), "o_orderkey")
    return match.snapshot_diff(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["k"], ["o_orderstatus", "f"])


@query(
    "multiset_compare",
    "with x as (select l_returnflag, l_linestatus, l_partkey, count(*) filter (l_orderkey % 2 = 0) as n_a, count(*) filter (l_orderkey % 2 = 1) as n_b from lineitem group by all) select l_returnflag, l_linestatus, l_partkey, n_a, n_b from x where n_a <> n_b",
)
def multiset_compare(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    facts = ["l_returnflag", "l_linestatus", "l_partkey"]
    return match.multiset_diff(li.where("l_orderkey % 2 = 0").select(*facts), li.where("l_orderkey % 2 = 1").select(*facts))


@query("full_replacement", f"with {_RELEASES}, w as (select county, tax_year, release_kind from rel qualify row_number() over (partition by county order by tax_year desc, precedence desc, as_of desc) = 1) select account_id, a.county, a.tax_year, a.release_kind, a.value::double as value from accounts a join w using (county, tax_year, release_kind)")
def full_replacement(spark, sf_dir):
    winners = release.latest_per_key(releases(spark, sf_dir), ["county"], [F.desc("tax_year"), F.desc("precedence"), F.desc("as_of")])
    r = match.full_replacement(accounts(spark, sf_dir), winners, ["county", "tax_year", "release_kind"])
    return r.select("account_id", "county", "tax_year", "release_kind", F.col("value").cast("double").alias("value"))


@query("union_history", f"with {A} select account_id, release_kind, value::double as value, case when release_kind = 'proposed' then o_custkey end as notice from accounts")
def union_history(spark, sf_dir):
    a = accounts(spark, sf_dir).withColumn("value", F.col("value").cast("double"))
    kinds = [a.where(F.col("release_kind") == k).select("account_id", "release_kind", "value") for k in ("certified", "certified-with-supplemental")]
    return match.history(a.where("release_kind = 'proposed'").select("account_id", "release_kind", "value", F.col("o_custkey").alias("notice")), *kinds)


@query("county_qualified_identity", "select c_mktsegment as segment, count(distinct c_custkey % 100) as n_ids, count(distinct (c_nationkey, c_custkey % 100)) as n_qualified from customer group by 1")
def county_qualified_identity(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), "c_nationkey", (F.col("c_custkey") % 100).alias("id"))
    return match.qualified_identities(c, "c_nationkey", "id", ["segment"])


@query("artifact_shared_partitions", "select sha256(text) as sha256, count(distinct source) as n_partitions, count(*) as n_references from documents group by 1 having count(distinct source) > 1")
def artifact_shared_partitions(spark, sf_dir):
    return match.shared_partitions(table(spark, sf_dir, "documents"), F.sha2(F.col("text").cast("binary"), 256), F.col("source"))
