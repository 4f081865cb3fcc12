"""Source rows reshaped into records and long values."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwright.operators import reshape
from parcelwright.plans.registry import query
from parcelwright.sources.views import money, owner_rows, table

_MONEY = "cast(cast({c} as decimal(18,2)) as varchar)"


@query("convert_delimited", "select cast(c_custkey as varchar) as account_id, c_mktsegment as source_status, c_name as name_id, 1 as n_identifiers, case when c_custkey % 3 = 0 then 1 else 2 end as n_values, cast(cast(c_acctbal as decimal(18,2)) as varchar) as balance from customer")
def convert_delimited(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("c_acctbal", money("c_acctbal")).withColumn("c_nationkey", F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_nationkey").cast("string")))
    r = reshape.shared_records(c, "c_custkey", {"NAME": "c_name"}, ["c_acctbal", "c_nationkey"], status="c_mktsegment")
    return r.select("account_id", "source_status", F.col("identifiers")["NAME"].alias("name_id"), F.size("identifiers").alias("n_identifiers"), F.size("native_values").alias("n_values"), F.col("native_values")["c_acctbal"].alias("balance"))


@query("convert_owner_rows", "select l_orderkey as prop_id, count(*) as n_records, count(distinct l_linenumber) as n_sequences, min(cast(year(l_shipdate) as int)) as first_year from lineitem group by 1")
def convert_owner_rows(spark, sf_dir):
    r = reshape.shared_records(owner_rows(spark, sf_dir), "prop_id", {"PROP": "prop_id", "SEQ": "owner_sequence"}, ["flag", "status"], year="tax_year")
    return r.groupBy(F.col("account_id").cast("long").alias("prop_id")).agg(F.count("*").alias("n_records"), F.count_distinct(F.col("identifiers")["SEQ"]).alias("n_sequences"), F.min("appraisal_year").alias("first_year"))


@query("convert_children", f"select cast(l_orderkey as varchar) as account_id, cast(l_linenumber as varchar) as child_sequence, case when l_returnflag <> 'A' then {_MONEY.format(c='l_extendedprice')} end as child_value from lineitem")
def convert_children(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("child_value", F.when(F.col("l_returnflag") != "A", money("l_extendedprice").cast("string")))
    r = reshape.shared_records(li, "l_orderkey", {"SEQ": "l_linenumber"}, ["child_value"])
    return r.select("account_id", F.col("identifiers")["SEQ"].alias("child_sequence"), F.col("native_values")["child_value"].alias("child_value"))


@query(
    "dual_roll_split",
    """select l_orderkey, l_linenumber, 'current' as family, cast(cast(l_extendedprice as decimal(18,2)) as double) as market, l_quantity as assessed from lineitem
    union all select l_orderkey, l_linenumber, 'certified', case when l_linestatus = 'F' then cast(cast(l_extendedprice as decimal(18,2)) as double) end, l_discount from lineitem where l_returnflag = 'R'""",
)
def dual_roll_split(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", money("l_extendedprice").cast("double").alias("curr"), F.col("l_quantity").alias("curr2"), F.when(F.col("l_linestatus") == "F", money("l_extendedprice").cast("double")).alias("cert"), F.col("l_discount").alias("cert2"), F.when(F.col("l_returnflag") == "R", F.year("l_shipdate")).alias("cert_year"))
    return reshape.dual_roll_split(li, {"market": "curr", "assessed": "curr2"}, {"market": "cert", "assessed": "cert2"}, "cert_year").select("l_orderkey", "l_linenumber", "family", "market", "assessed")


@query("unpivot_native_values", "select p_partkey, 'p_name' as source_field, p_name as lexical_text from part union all select p_partkey, 'p_brand', p_brand from part where p_partkey % 5 > 0 union all select p_partkey, 'p_size', cast(p_size as varchar) from part where p_size > 10")
def unpivot_native_values(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("p_brand", F.when(F.col("p_partkey") % 5 > 0, F.col("p_brand"))).withColumn("p_size", F.when(F.col("p_size") > 10, F.col("p_size")))
    return reshape.native_values(p, ["p_partkey"], {"p_name": "text", "p_brand": "text", "p_size": "integer"}).select("p_partkey", "source_field", "lexical_text")


@query("unpivot_identifiers", "select o_orderkey, 'CUST' as source_name, cast(o_custkey as varchar) as identifier from orders union all select o_orderkey, 'PRIORITY', o_orderpriority from orders where o_orderstatus <> 'P'")
def unpivot_identifiers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("pri", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))).withColumn("_key", F.col("o_orderkey"))
    r = reshape.shared_records(o, "o_orderkey", {"CUST": "o_custkey", "PRIORITY": "pri"}, [])
    return r.select(F.col("_key").alias("o_orderkey"), F.explode("identifiers").alias("source_name", "identifier"))


@query("pivot_values", "select p_partkey, p_name, case when p_partkey % 5 > 0 then p_brand end as p_brand, cast(p_size as varchar) as p_size from part")
def pivot_values(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("p_brand", F.when(F.col("p_partkey") % 5 > 0, F.col("p_brand")))
    fields = {"p_name": "text", "p_brand": "text", "p_size": "integer"}
    return reshape.pivot_values(reshape.native_values(p, ["p_partkey"], fields), ["p_partkey"], list(fields))


@query("extras_retention", f"select s_suppkey, s_nationkey, 2 as n_extras, 'S_ACCTBAL,S_NAME' as warned, s_name as extra_name, {_MONEY.format(c='s_acctbal')} as extra_balance from supplier")
def extras_retention(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("s_acctbal", money("s_acctbal"))
    r = reshape.retain_extras(s, ["s_suppkey", "s_nationkey"])
    return r.select("s_suppkey", "s_nationkey", F.size("extras").alias("n_extras"), F.concat_ws(",", F.col("warnings.field_name")).alias("warned"), F.col("extras")["S_NAME"].alias("extra_name"), F.col("extras")["S_ACCTBAL"].alias("extra_balance"))


@query(
    "taxable_by_jurisdiction",
    """select o_orderkey, 'county' as unit, cast(cast(o_totalprice as decimal(18,2)) as double) as taxable from orders
    union all select o_orderkey, 'city', cast(cast(o_totalprice as decimal(18,2)) * 0.5 as double) from orders where o_orderstatus = 'F' union all select o_orderkey, 'school', cast(cast(o_totalprice as decimal(18,2)) - 10 as double) from orders where o_custkey % 2 = 0""",
)
def taxable_by_jurisdiction(spark, sf_dir):
    v = money("o_totalprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", v.cast("double").alias("a"), F.when(F.col("o_orderstatus") == "F", (v * F.lit(0.5).cast("decimal(2,1)")).cast("double")).alias("b"), F.when(F.col("o_custkey") % 2 == 0, (v - 10).cast("double")).alias("c"))
    return reshape.unpivot_taxable(o, ["o_orderkey"], {"county": "a", "city": "b", "school": "c"})
