"""Row and cross-row validation over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwright.operators import validate
from parcelwright.plans.registry import query
from parcelwright.sources import views
from parcelwright.sources.views import accounts, members, money, owner_rows, table

A, O, M = views.ACCOUNTS_SQL, views.OWNER_ROWS_SQL, views.MEMBERS_SQL

_HEADERS_SQL = """h as (select o_custkey as member, o_orderkey as position, case when o_orderkey % 97 = 0 then '  ' when o_orderkey % 31 = 0 then lower(o_orderpriority) else o_orderpriority end as name from orders)"""


@query(
    "header_contract",
    f"""with {_HEADERS_SQL}, n as (select member, name, count(*) as n from h where trim(name) <> '' group by all), r(name) as (values ('1-URGENT'), ('5-LOW'), ('9-NONE')), m as (select distinct member from h)
    select member, 'blank_header' as code, name from h where trim(name) = ''
    union all select member, 'duplicate_header', name from n where n > 1
    union all select n.member, 'header_name_collision', n.name from n where (select count(*) from n k where k.member = n.member and lower(k.name) = lower(n.name)) > 1
    union all select m.member, 'missing_required_header', r.name from m cross join r where not exists (select 1 from n where n.member = m.member and n.name = r.name)
    union all select member, 'extra_columns_present', name from n where name not in (select name from r)""",
)
def header_contract(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 97 == 0, "  ").when(F.col("o_orderkey") % 31 == 0, F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority"))
    return validate.header_diagnostics(o.select(F.col("o_custkey").alias("member"), F.col("o_orderkey").alias("position"), name.alias("name")), ["1-URGENT", "5-LOW", "9-NONE"])


@query(
    "column_descriptor_contract",
    """with o as (select cast(p_size as varchar) as "table", p_brand as "column", max(length(p_name)) as width, min(p_type) as kind from part group by all), c as (select cast(p_size as varchar) as "table", p_brand as "column", min(10) as width, max(p_type) as kind from part where p_partkey % 3 > 0 group by all),
    j as (select coalesce(o."table", c."table") as t, coalesce(o."column", c."column") as k, o."column" as ok, c."column" as ck, o.width as ow, c.width as cw, o.kind as okind, c.kind as ckind from o full join c on o."table" = c."table" and o."column" = c."column")
    select t as "table", k as "column", 'missing_required_column' as code from j where ok is null union all select t, k, 'extra_columns_present' from j where ck is null
    union all select t, k, 'incompatible_width' from j where ok is not null and ck is not null and ow is distinct from cw union all select t, k, 'incompatible_kind' from j where ok is not null and ck is not null and okind is distinct from ckind""",
)
def column_descriptor_contract(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("table"), F.col("p_brand").alias("column"), "p_name", "p_type", "p_partkey")
    observed = p.groupBy("table", "column").agg(F.max(F.length("p_name")).alias("width"), F.min("p_type").alias("kind"))
    contract = p.where("p_partkey % 3 > 0").groupBy("table", "column").agg(F.lit(10).alias("width"), F.max("p_type").alias("kind"))
    return validate.descriptor_diagnostics(observed, contract, ["width", "kind"])


@query("layout_gate", "select o_orderkey, o_orderstatus = 'F' and o_custkey % 10 > 0 and o_custkey % 7 > 0 as passes from orders")
def layout_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("property").alias("member_kind"), F.when(F.col("o_custkey") % 10 > 0, "f" * 64).otherwise("0" * 64).alias("fingerprint"), F.when(F.col("o_custkey") % 7 > 0, "f" * 64).otherwise("0" * 64).alias("expected"), F.col("o_orderstatus").alias("label"))
    pinned = spark.createDataFrame([("property", "f" * 64, "F")], "member_kind string, fingerprint string, label string")
    return validate.layout_gate(o, pinned).select("o_orderkey", "passes")


@query(
    "record_width",
    """with l as (select o_custkey as member, row_number() over (partition by o_custkey order by o_orderkey) as rn, length(case when o_orderkey % 101 = 0 then 'short' else lpad(cast(o_orderkey as varchar), 17, '0') end) as w, o_orderkey % 499 = 0 as bad from orders),
    b as (select member, min_by(w, rn) as w1, bool_or(bad) as any_bad from l group by 1),
    d as (select l.member, rn, case when any_bad then case when bad then 'invalid_source_text' end when w <> w1 then 'record_width_mismatch' when rn = 1 and w < 17 then 'record_width_mismatch' end as code from l join b using (member))
    select member, rn as physical_row_number, code from d where code is not null""",
)
def record_width(spark, sf_dir):
    from pyspark.sql import Window as W

    key = F.lpad(F.col("o_orderkey").cast("string"), 17, "0")
    value = F.when(F.col("o_orderkey") % 499 == 0, F.concat(F.lit("\x07"), F.substring(key, 2, 16))).when(F.col("o_orderkey") % 101 == 0, "short").otherwise(key)
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("member"), F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long").alias("physical_row_number"), value.alias("value"))
    return validate.width_diagnostics(lines, 17)


@query("row_width", "select c_custkey, 3 + c_custkey % 2 as n_fields from customer where c_custkey % 2 = 1")
def row_width(spark, sf_dir):
    line = F.concat_ws("|", F.concat(F.lit('"a|""b"" '), "c_name", F.lit('"')), "c_mktsegment", F.when(F.col("c_custkey") % 2 == 1, "x|y").otherwise("x"))
    return validate.row_width_diagnostics(table(spark, sf_dir, "customer"), line, r"\|", 3).select("c_custkey", F.col("n_fields").cast("long").alias("n_fields"))


_RULES_SQL = f"""with {A} select o_orderkey, len(list_filter([case when o_orderkey % 97 = 0 then 1 end, case when tax_year not between 1996 and 2000 then 2 end, case when value > 400000 then 3 end], lambda x: x is not null)) as n,
    array_to_string(list_filter([case when o_orderkey % 97 = 0 then 'invalid_account_id' end, case when tax_year not between 1996 and 2000 then 'invalid_tax_year' end, case when value > 400000 then 'out_of_range' end], lambda x: x is not null), ',') as codes from accounts"""


def _rules():
    """Rules of the account rows; every 97th account is spoilt by the caller."""
    from parcelwright.functions import text as t

    return [("invalid_account_id", "account_id", ~t.matches(F.col("account_id"), t.ACCOUNTS["digits17"])), ("invalid_tax_year", "tax_year", ~F.col("tax_year").between(1996, 2000)), ("out_of_range", "value", F.col("value") > 400000)]


def judged(spark, sf_dir):
    a = accounts(spark, sf_dir).withColumn("account_id", F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("x"), "account_id")).otherwise(F.col("account_id")))
    return validate.validate_rows(a, _rules())


@query("validate_rows", _RULES_SQL)
def validate_rows(spark, sf_dir):
    return judged(spark, sf_dir).select("o_orderkey", F.size("diagnostics").cast("long").alias("n"), F.concat_ws(",", F.col("diagnostics.code")).alias("codes"))


@query(
    "duplicate_key_first_wins",
    f"""with {O}, r as (select *, row_number() over (partition by prop_id, owner_sequence order by {views.ROW_ORDER_SQL}) as rn from owner_rows where flag <> 'N')
    select prop_id, owner_sequence, l_partkey, l_suppkey from r where rn > 1""",
)
def duplicate_key_first_wins(spark, sf_dir):
    return validate.duplicate_keys(owner_rows(spark, sf_dir), ["prop_id", "owner_sequence"], list(views.ROW_ORDER), F.col("flag") != "N").select("prop_id", "owner_sequence", "l_partkey", "l_suppkey")


@query(
    "fail_fast_first_error",
    f"""with {A}, d as (select county, tax_year, o_orderkey as rn, unnest(list_filter([case when o_orderkey % 97 = 0 then 'invalid_account_id' end, case when tax_year not between 1996 and 2000 then 'invalid_tax_year' end, case when value > 400000 then 'out_of_range' end], lambda x: x is not null)) as code from accounts)
    select county, tax_year, rn as physical_row_number, code from d qualify rn = min(rn) over (partition by county, tax_year)""",
)
def fail_fast_first_error(spark, sf_dir):
    d = judged(spark, sf_dir).select("county", "tax_year", F.col("o_orderkey").alias("physical_row_number"), F.explode("diagnostics").alias("d")).select("county", "tax_year", "physical_row_number", "d.code")
    return validate.first_failing_row(d, ["county", "tax_year"])


@query(
    "account_fact_conflict",
    f"""with {O}, r as (select *, first_value(struct_pack(a := tax_year, b := flag, c := status)) over (partition by prop_id order by owner_sequence, {views.ROW_ORDER_SQL} rows between unbounded preceding and current row) as f from owner_rows)
    select prop_id, owner_sequence, l_partkey, case when tax_year <> f.a then 'tax_year' when flag <> f.b then 'flag' else 'status' end as field from r where tax_year <> f.a or flag <> f.b or status <> f.c""",
)
def account_fact_conflict(spark, sf_dir):
    return validate.fact_conflicts(owner_rows(spark, sf_dir), ["prop_id"], ["tax_year", "flag", "status"], ["owner_sequence", *views.ROW_ORDER]).select("prop_id", "owner_sequence", "l_partkey", "field")


@query(
    "account_group_profile",
    f"""with {O} select prop_id, count(*) as n_rows, count(distinct (tax_year, flag)) as n_facts, count(distinct (owner_sequence, l_suppkey)) as n_owners,
    case when count(distinct (tax_year, flag)) > 1 then 'conflict' when count(distinct (owner_sequence, l_suppkey)) > 1 then 'owner_differences' else 'consistent' end as verdict from owner_rows group by 1""",
)
def account_group_profile(spark, sf_dir):
    return validate.account_group_profile(owner_rows(spark, sf_dir), ["prop_id"], ["tax_year", "flag"], ["owner_sequence", "l_suppkey"])


_CHILD_SQL = "c as (select l_orderkey as prop_id, l_linenumber, l_partkey, case when l_linenumber <= 3 then 'land' when l_linenumber <= 5 then 'improvement' else 'lawsuit' end as child_table from lineitem), p as (select o_orderkey as prop_id from orders where o_orderstatus <> 'P')"


def children(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_linenumber") <= 3, "land").when(F.col("l_linenumber") <= 5, "improvement").otherwise("lawsuit")
    c = li.select(F.col("l_orderkey").alias("prop_id"), "l_linenumber", "l_partkey", kind.alias("child_table"))
    parents = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("prop_id"))
    return validate.child_orphans(c, parents, ["prop_id"], F.col("child_table") != "lawsuit")


@query("child_orphans", f"with {_CHILD_SQL} select prop_id, l_linenumber, l_partkey, child_table, case when not exists (select 1 from p where p.prop_id = c.prop_id) then case when child_table = 'lawsuit' then 'legal_child_orphaned' else 'core_child_orphaned' end end as code from c")
def child_orphans(spark, sf_dir):
    return children(spark, sf_dir)


@query(
    "core_children_zero_orphans",
    f"with {_CHILD_SQL}, x as (select child_table, not exists (select 1 from p where p.prop_id = c.prop_id) as o from c) select child_table, count(*) as n_children, count(*) filter (o) as n_orphans, count(*) filter (o) <= case child_table when 'lawsuit' then 1000000 else 0 end as passes from x group by 1",
)
def core_children_zero_orphans(spark, sf_dir):
    return validate.orphan_gate(children(spark, sf_dir), {"lawsuit": 1_000_000})


@query(
    "record_release_agreement",
    f"with {A} select account_id, case when (tax_year % 2 = 0) <> (o_orderkey % 2 = 0) then 'parity' when release_kind <> 'certified' then 'release_kind' end as field from accounts",
)
def record_release_agreement(spark, sf_dir):
    a = accounts(spark, sf_dir).withColumn("parity", F.col("o_orderkey") % 2)
    releases = a.select("county", "tax_year").distinct().withColumn("parity", (F.col("tax_year") % 2).cast("long")).withColumn("release_kind", F.lit("certified"))
    return validate.record_agreement(a, releases, ["county", "tax_year"], ["parity", "release_kind"]).select("account_id", "field")


@query("certified_family_consistency", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_returnflag <> 'R' and (l_discount > 0.08 or l_tax > 0.07)")
def certified_family_consistency(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("cert_year", F.when(F.col("l_returnflag") == "R", F.year("l_shipdate"))).withColumn("a", F.when(F.col("l_discount") > 0.08, 1)).withColumn("b", F.when(F.col("l_tax") > 0.07, 1))
    return validate.family_consistency(li, "cert_year", ["a", "b"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("value_hierarchy", "select l_returnflag as flag, count(*) filter (l_tax > 0) as n_comparable, count(*) filter (l_tax > 0 and cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) > cast(l_extendedprice as decimal(18,2)) - 2000) as n_violations from lineitem group by 1")
def value_hierarchy(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), (money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("low"), F.when(F.col("l_tax") > 0, money("l_extendedprice") - 2000).alias("high"))
    return validate.value_hierarchy(li, "low", "high", ["flag"])


_HOPS_SQL = """hops as (select page_id // 4 as chain, page_id % 4 as hop, url as from_url, case when page_id % 9 = 0 then 'x' else lead(url) over (order by page_id) end as to_url, regexp_extract(url, '://([^/]*)', 1) as host, 301 + (page_id % 5) * 30 as status from pages)"""


@query(
    "redirect_chain_check",
    f"""with {_HOPS_SQL}, l as (select *, lag(to_url) over (partition by chain order by hop) as prev from hops), a as (select distinct host from hops where length(host) % 3 > 0)
    select chain, hop, 'host_not_allowed' as code from l where host not in (select host from a) union all select chain, hop, 'scheme_not_allowed' from l where not starts_with(from_url, 'https:') union all select chain, hop, 'status_not_redirect' from l where status not between 300 and 399
    union all select chain, hop, 'broken_chain' from l where prev <> from_url union all select chain, hop, 'too_many_redirects' from l where hop > 2""",
)
def redirect_chain_check(spark, sf_dir):
    from pyspark.sql import Window as W

    p = table(spark, sf_dir, "pages").select("page_id", "url")
    after = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next"))
    hops = p.join(after, "page_id", "left").select(F.expr("page_id div 4").alias("chain"), (F.col("page_id") % 4).alias("hop"), F.col("url").alias("from_url"), F.when(F.col("page_id") % 9 == 0, "x").otherwise(F.col("next")).alias("to_url"), F.regexp_extract("url", "://([^/]*)", 1).alias("host"), (301 + (F.col("page_id") % 5) * 30).alias("status"))
    return validate.redirect_chain(hops, hops.where("length(host) % 3 > 0"), 2)


@query(
    "archive_member_audit",
    f"""with {M}, g as (select * from members where doc_id % 23 > 0), s as (select archive, count(*) as n, sum(declared) as d, sum(compressed) as c from g group by 1)
    select archive, name, 'unsupported_media_type' as code from g where name like 'es/%' union all select archive, name, 'member_too_large' from g where declared > 5000
    union all select archive, name, 'compression_ratio_too_high' from g where declared / compressed > 5 union all select archive, null, 'too_many_members' from s where n > 48 union all select archive, null, 'expansion_too_large' from s where d > 120000 union all select archive, null, 'compression_ratio_too_high' from s where d > c * 4.0
    union all select archive, null, 'unreadable_archive' from members where doc_id % 23 = 0 union all select archive, name, 'unsupported_member_type' from g where doc_id % 11 = 0 union all select archive, name, 'encrypted_member' from g where doc_id % 13 = 0
    union all select archive, name, 'unsupported_compression' from g where doc_id % 5 = 0 union all select archive, name, 'corrupt_member' from g where doc_id % 17 = 0""",
)
def archive_member_audit(spark, sf_dir):
    nth = lambda n: F.col("doc_id") % n == 0
    m = members(spark, sf_dir).withColumns({"readable": ~nth(23), "kind": F.when(nth(11), "link").otherwise("file"), "encrypted": nth(13), "method": F.when(nth(5), 12).otherwise(8), "intact": ~nth(17)})
    kinds = m.withColumn("name", F.when(F.col("lang") == "es", F.regexp_replace("name", r"\.txt\z", ".exe")).otherwise(F.col("name")))
    found = validate.archive_audit(kinds, [".txt", ".csv"], 5000, 4.0, 48, 120_000, most_member_ratio=5.0)
    return found.withColumn("name", F.regexp_replace("name", r"\.exe\z", ".txt"))


@query(
    "member_set_drift",
    """with o as (select source as archive, lang, count(*) as n from documents where doc_id % 10 < 5 group by all), e as (select distinct source as archive, lang from documents where doc_id % 10 >= 5)
    select coalesce(o.archive, e.archive) as archive, coalesce(o.lang, e.lang) as lang, coalesce(n, 0) as n, case when n is null then 'missing' when e.archive is null then 'unexpected' else 'duplicated' end as code from o full join e on o.archive = e.archive and o.lang = e.lang where n is null or e.archive is null or n > 1""",
)
def member_set_drift(spark, sf_dir):
    m = members(spark, sf_dir).select("archive", "lang", "doc_id")
    return validate.member_set_drift(m.where("doc_id % 10 < 5"), m.where("doc_id % 10 >= 5"), ["archive", "lang"])


@query(
    "exactly_one_member",
    """with a as (select source as archive, upper(lang) || '-' || n_chars // 10 as tbl, count(*) as n from documents group by all), e as (select distinct source as archive, upper(lang) || '-' || (n_chars + 10) // 10 as tbl from documents)
    select e.archive, e.tbl, coalesce(n, 0) as n, coalesce(n, 0) = 1 as resolved from e left join a on e.archive is not distinct from a.archive and e.tbl is not distinct from a.tbl""",
)
def exactly_one_member(spark, sf_dir):
    """Members' logical tables by language and length; expected is each table that is one step longer than some member's."""
    m = members(spark, sf_dir)
    named = lambda chars: F.concat(F.upper("lang"), F.lit("-"), F.floor(chars / 10).cast("string"))
    observed = m.select("archive", named(F.col("declared")).alias("tbl"))
    expected = m.select("archive", named(F.col("declared") + 10).alias("tbl"))
    return validate.exactly_one_member(observed, expected, ["archive", "tbl"])


@query(
    "check_constraints",
    f"with {A} select account_id, 'year_range' as violation from accounts where tax_year not between 1996 and 2000 union all select account_id, 'value_positive' from accounts where value < 50000 union all select account_id, 'kind_known' from accounts where release_kind not in ('proposed', 'certified')",
)
def check_constraints(spark, sf_dir):
    checks = {"year_range": F.col("tax_year").between(1996, 2000), "value_positive": F.col("value") >= 50000, "kind_known": F.col("release_kind").isin("proposed", "certified")}
    return validate.constraint_violations(accounts(spark, sf_dir), checks, ["account_id"])


@query("referential_lineage", "select l_orderkey, l_linenumber, l_partkey from lineitem where not exists (select 1 from orders join customer on o_custkey = c_custkey where o_orderkey = l_orderkey and o_orderstatus = case when l_linestatus = 'F' then 'F' else 'O' end)")
def referential_lineage(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linestatus") == "F", "F").otherwise("O").alias("status"))
    runs = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return validate.lineage_violations(li, runs.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status")), ["l_orderkey", "status"]).drop("status")


@query(
    "shared_provenance_agreement",
    "select o.o_orderkey, array_to_string(list_filter([case when o.o_custkey is distinct from n.o_custkey then 'customer' end, case when o.o_orderstatus is distinct from n.o_orderstatus then 'status' end, case when o.o_orderpriority is distinct from n.o_orderpriority then 'priority' end], lambda x: x is not null), ',') as fields from orders o left join orders n on n.o_orderkey = o.o_orderkey + 1",
)
def shared_provenance_agreement(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    n = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    met = o.join(n, "o_orderkey", "left")
    pairs = {"customer": (F.col("o_custkey"), F.col("c")), "status": (F.col("o_orderstatus"), F.col("s")), "priority": (F.col("o_orderpriority"), F.col("p"))}
    return met.select("o_orderkey", F.concat_ws(",", validate.provenance_mismatch(met, pairs)).alias("fields"))
