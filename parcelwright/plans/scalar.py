"""Lexical rules applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwright.functions import text as t
from parcelwright.operators import reshape
from parcelwright.plans.registry import query
from parcelwright.sources.views import money, table

_WS29 = " || ".join(f"chr({ord(c)})" for c in t.NAME_BLANKS)
_WS6 = " || ".join(f"chr({ord(c)})" for c in t.ASCII_BLANKS)


@query("ascii_trim", f"with x as (select doc_id, repeat(' ' || chr(9), doc_id % 3) || text || repeat(chr(13) || chr(10) || chr(12), doc_id % 2) as x from documents) select doc_id, trim(x, {_WS6}) as trimmed, length(x) - length(trim(x, {_WS6})) as n_cut from x")
def ascii_trim(spark, sf_dir):
    """Whole texts, padded with blanks by their ids."""
    x = F.concat(F.repeat(F.lit(" \t"), (F.col("doc_id") % 3).cast("int")), "text", F.repeat(F.lit("\r\n\x0c"), (F.col("doc_id") % 2).cast("int")))
    d = table(spark, sf_dir, "documents").select("doc_id", x.alias("x"))
    return d.select("doc_id", t.ascii_trim(F.col("x")).alias("trimmed"), (F.length("x") - F.length(t.ascii_trim(F.col("x")))).cast("long").alias("n_cut"))


@query("is_named", f"select lang, count(*) as n, count(*) filter (trim(substr(text, 1, 1), {_WS29}) <> '') as n_named, count(*) filter (trim(text, {_WS29}) <> '') as n_texts from documents group by lang")
def is_named(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(t.is_named(F.substring("text", 1, 1))).alias("n_named"), F.count_if(t.is_named(F.col("text"))).alias("n_texts"))


@query(
    "identifier_grammar",
    r"""with x as (select page_id, regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) as seg, 'tx-' || lower(regexp_extract(url, '^[a-z]+://([^/.]*)', 1)) as jur from pages)
    select page_id, seg, regexp_full_match(seg, '[A-Za-z0-9_][A-Za-z0-9._-]{0,127}') as is_identifier, regexp_full_match(jur, '[a-z]{2}-[a-z0-9-]+') as is_jurisdiction from x""",
)
def identifier_grammar(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"([^/?#]*)([?#].*)?$", 1).alias("seg"), F.concat(F.lit("tx-"), F.lower(F.regexp_extract("url", r"^[a-z]+://([^/.]*)", 1))).alias("jur"))
    return p.select("page_id", "seg", t.matches(F.col("seg"), t.IDENTIFIER).alias("is_identifier"), t.matches(F.col("jur"), t.JURISDICTION).alias("is_jurisdiction"))


@query(
    "lexical_account",
    r"""with x as (select o_orderkey, case when o_orderkey % 11 = 0 then ' ' || lpad(cast(o_orderkey as varchar), 16, '0') when o_orderkey % 13 = 0 then lpad(cast(o_orderkey as varchar), 40, 'x') else lpad(cast(o_orderkey as varchar), 17, '0') end as a from orders)
    select o_orderkey, a as account, regexp_full_match(a, '[0-9]{17}') as digits17, regexp_full_match(a, '[\x21-\x7e]{1,64}') as visible64, regexp_full_match(a, '[\x21-\x7e]{1,32}') as visible32,
      regexp_full_match(cast(o_orderkey as varchar), '[0-9]{1,4}') as sequence from x""",
)
def lexical_account(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    a = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit(" "), F.lpad(key, 16, "0"))).when(F.col("o_orderkey") % 13 == 0, F.lpad(key, 40, "x")).otherwise(F.lpad(key, 17, "0"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", a.alias("account"))
    return o.select("o_orderkey", "account", *(t.matches(F.col("account") if k != "sequence" else F.col("o_orderkey").cast("string"), g).alias(k) for k, g in t.ACCOUNTS.items()))


_AMOUNT_SQL = """case o_orderkey % 7 when 0 then cast(cast(o_totalprice as decimal(18,2)) as varchar) when 1 then ' ' || cast(cast(o_totalprice as decimal(18,2)) as varchar) || ' '
  when 2 then cast(cast(o_totalprice as decimal(18,2)) as varchar) || '345' when 3 then '1e5' when 4 then '-' || cast(cast(o_totalprice as decimal(18,2)) as varchar) when 5 then null else cast(o_orderkey as varchar) end"""


@query(
    "exact_decimal_parse",
    f"""with x as (select o_orderkey, {_AMOUNT_SQL} as lexical from orders), y as (select *, trim(lexical, {_WS6}) as z from x),
    c as (select *, case when lexical is null then null when not regexp_full_match(z, '[0-9]+(\\.[0-9]{{1,4}})?') then 'bad_grammar' end as code from y)
    select o_orderkey, lexical, code, case when code is null then cast(cast(z as decimal(38,4)) as double) end as amount from c""",
)
def exact_decimal_parse(spark, sf_dir):
    price = money("o_totalprice").cast("string")
    k = F.col("o_orderkey") % 7
    lexical = F.when(k == 0, price).when(k == 1, F.concat(F.lit(" "), price, F.lit(" "))).when(k == 2, F.concat(price, F.lit("345"))).when(k == 3, "1e5").when(k == 4, F.concat(F.lit("-"), price)).when(k == 5, None).otherwise(F.col("o_orderkey").cast("string"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", lexical.alias("lexical")).withColumn("x", t.exact_decimal(F.col("lexical"), "four_places"))
    return o.select("o_orderkey", "lexical", F.col("x.code").alias("code"), F.col("x.value").cast("double").alias("amount"))


@query(
    "decode_numeric_wrapper",
    "select o_orderkey, case when o_orderkey % 5 = 1 then -1 else 1 end * (o_orderkey * 4294967296.0 + o_custkey) / 100 as amount, cast(null as varchar) as code from orders where o_orderkey % 10 <> 9 and not (o_orderkey % 5 = 1 and o_orderkey = 0) union all select o_orderkey, null, 'numeric_precision_overflow' from orders where o_orderkey % 10 = 9",
)
def decode_numeric_wrapper(spark, sf_dir):
    """Buffers with the key in the third word and the customer in the fourth; every tenth has its first word set."""
    word = lambda c: F.concat(*(F.substring(F.lpad(F.hex(c), 8, "0"), i, 2) for i in (7, 5, 3, 1)))
    sign = F.when(F.col("o_orderkey") % 5 == 1, "01").otherwise("00")
    top = F.when(F.col("o_orderkey") % 10 == 9, F.lit(1)).otherwise(F.lit(0)).cast("long")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.concat(sign, word(top), word(F.lit(0).cast("long")), word(F.col("o_orderkey")), word(F.col("o_custkey")))).alias("buffer"))
    x = o.withColumn("x", t.decode_numeric(F.col("buffer"), F.lit(28), 2))
    return x.select("o_orderkey", F.col("x.value").cast("double").alias("amount"), F.col("x.code").alias("code"))


@query(
    "date_grammar",
    r"""with x as (select o_orderkey, case o_orderkey % 6 when 0 then '2/29/' || year(o_orderdate) when 1 then '13/1/1999' when 2 then strftime(o_orderdate, '%m-%d-%Y') when 3 then strftime(o_orderdate, '%-m/%-d/') || '1899' else strftime(o_orderdate, '%-m/%-d/%Y') end as d from orders)
    select o_orderkey, d, case when regexp_full_match(d, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') then coalesce(try_strptime(d, '%m/%d/%Y') is not null and cast(right(d, 4) as int) between 1900 and 2100, false) else false end as is_date from x""",
)
def date_grammar(spark, sf_dir):
    k, day = F.col("o_orderkey") % 6, F.col("o_orderdate")
    d = F.when(k == 0, F.concat(F.lit("2/29/"), F.year(day))).when(k == 1, "13/1/1999").when(k == 2, F.date_format(day, "MM-dd-yyyy")).when(k == 3, F.concat(F.date_format(day, "M/d/"), F.lit("1899"))).otherwise(F.date_format(day, "M/d/yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("d")).select("o_orderkey", "d", t.is_date(F.col("d")).alias("is_date"))


@query("control_char_reject", r"select source, count(*) as n, count(*) filter (regexp_matches(text, '[\x00-\x1f\x7f-\x{9f}]')) as n_rejected from documents group by source")
def control_char_reject(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(t.has_control(F.col("text"))).alias("n_rejected"))


@query("bounded_text", r"select doc_id, length(text) <= 512 and not regexp_matches(text, '[\x00-\x1f\x7f-\x{9f}]') as id_ok, length(text) <= 128 and not regexp_matches(text, '[\x00-\x1f\x7f-\x{9f}]') as text_ok from documents")
def bounded_text(spark, sf_dir):
    x = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", t.is_bounded_text(x, 512).alias("id_ok"), t.is_bounded_text(x, 128).alias("text_ok"))


@query(
    "normalize_header",
    f"""with x as (select p_partkey, ' ' || p_name || chr(9) as raw from part) select p_partkey, upper(trim(raw, {_WS6})) as normalized, translate(raw, '{t.UPPER}', '{t.LOWER}') as folded,
    count(*) over (partition by translate(trim(raw, {_WS6}), '{t.UPPER}', '{t.LOWER}')) as n_colliding from x""",
)
def normalize_header(spark, sf_dir):
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit("\t"))
    x = table(spark, sf_dir, "part").select("p_partkey", t.normalize_header(raw).alias("normalized"), t.ascii_fold(raw).alias("folded"))
    sizes = x.groupBy(t.ascii_fold(t.ascii_trim(F.col("folded"))).alias("k")).agg(F.count("*").alias("n_colliding"))
    return x.join(sizes, t.ascii_fold(t.ascii_trim(x["folded"])) == F.col("k")).drop("k")


@query(
    "layout_fingerprint",
    """with h as (select o_custkey as layout, list_sort(list_distinct(list(o_orderpriority))) as names from orders group by 1)
    select layout, len(names) as n_names, sha256('{"headers":' || '["' || array_to_string(names, '","') || '"]' || ',"parser_contract_version":1}') as fingerprint from h""",
)
def layout_fingerprint(spark, sf_dir):
    h = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("layout")).agg(F.collect_set("o_orderpriority").alias("names"))
    return h.select("layout", F.size("names").cast("long").alias("n_names"), t.layout_fingerprint(F.col("names"), 1).alias("fingerprint"))


@query(
    "sanitize_url",
    r"select page_id, case when regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#]*@)?([^/?#@:]+)(:[0-9]+)?([^?#]*)', 2) <> '' then lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#]*@)?([^/?#@:]+)(:[0-9]+)?([^?#]*)', 1)) || '://' || lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#]*@)?([^/?#@:]+)(:[0-9]+)?([^?#]*)', 2)) || regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#]*@)?([^/?#@:]+)(:[0-9]+)?([^?#]*)', 3) || regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#]*@)?([^/?#@:]+)(:[0-9]+)?([^?#]*)', 4) end as url, url like '%?%' as had_query from pages",
)
def sanitize_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", t.sanitize_url(F.col("url")).alias("url"), F.col("url").like("%?%").alias("had_query"))


@query("sanitize_headers", r"select event_id, 2 as n_kept, event_type as content_type, left(regexp_replace(props, '[\x00-\x1f\x7f-\x{9f}]', '', 'g'), 512) as etag from events")
def sanitize_headers(spark, sf_dir):
    headers = F.create_map(F.lit("Content-Type"), F.col("event_type"), F.lit("ETag"), F.concat("props", F.lit("\x07")), F.lit("Set-Cookie"), F.col("user_id").cast("string"))
    e = table(spark, sf_dir, "events").select("event_id", t.sanitize_headers(headers, 512).alias("h"))
    return e.select("event_id", F.size("h").alias("n_kept"), F.col("h")["content-type"].alias("content_type"), F.col("h")["etag"].alias("etag"))


@query(
    "native_value_of",
    """with c as (select c_custkey, case when c_custkey % 4 = 0 then ' ' else c_mktsegment end as seg, c_nationkey, cast(c_acctbal as decimal(18,2)) as bal from customer)
    select c_custkey, 'c_mktsegment' as source_field, seg as lexical_text, seg as text_value, null::bigint as integer_value, null::double as numeric_value from c where trim(seg) <> ''
    union all select c_custkey, 'c_nationkey', cast(c_nationkey as varchar), null, c_nationkey, null from c
    union all select c_custkey, 'c_acctbal', cast(bal as varchar), null, null, cast(bal as double) from c""",
)
def native_value_of(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 == 0, " ").otherwise(F.col("c_mktsegment"))).withColumn("c_acctbal", money("c_acctbal"))
    long = reshape.native_values(c, ["c_custkey"], {"c_mktsegment": "text", "c_nationkey": "integer", "c_acctbal": "numeric"})
    return long.select("c_custkey", "source_field", "lexical_text", "text_value", "integer_value", F.col("numeric_value").cast("double").alias("numeric_value"))


@query("sensitive_projection", "select c_custkey, c_nationkey, c_mktsegment, cast(cast(c_acctbal as decimal(18,2)) as double) as c_acctbal from customer")
def sensitive_projection(spark, sf_dir):
    c = reshape.non_sensitive(table(spark, sf_dir, "customer"), ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"], ["c_name"])
    return c.withColumn("c_acctbal", money("c_acctbal").cast("double"))


@query(
    "media_and_length",
    "select doc_id, 'text/plain' as media_type, case when length(text) < n_chars + doc_id % 3 - 1 then 'truncated' when length(text) > n_chars + doc_id % 3 - 1 then 'too_long' end as code from documents",
)
def media_and_length(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    kind = F.concat(F.lit("Text/Plain ; charset="), F.col("lang"))
    return d.select("doc_id", t.media_type(kind).alias("media_type"), t.length_code(F.col("n_chars") + F.col("doc_id") % 3 - 1, F.length("text")).alias("code"))


@query(
    "typed_value_long",
    """select p_partkey, 'p_name' as source_field, p_name as text_value, null::bigint as integer_value, null::double as numeric_value, null::int as numeric_precision, null::int as numeric_scale, true as is_exact from part
    union all select p_partkey, 'p_size', null, p_size, null, null, null, true from part
    union all select p_partkey, 'p_retailprice', null, null, cast(cast(p_retailprice as decimal(18,2)) as double), 18, 2, true from part""",
)
def typed_value_long(spark, sf_dir):
    long = reshape.native_values(table(spark, sf_dir, "part").withColumn("p_retailprice", money("p_retailprice")), ["p_partkey"], {"p_name": "text", "p_size": "integer", "p_retailprice": "numeric"})
    return long.select("p_partkey", "source_field", "text_value", "integer_value", F.col("numeric_value").cast("double").alias("numeric_value"), "numeric_precision", "numeric_scale", reshape.exactly_one_value().alias("is_exact"))


@query(
    "estimated_tax",
    "select l_orderkey, l_linenumber, l_partkey, cast(cast(l_extendedprice as decimal(18,2)) as double) as taxable, cast(cast(l_tax as decimal(9,6)) as double) as rate, cast(year(l_shipdate) as int) as rate_year, cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(9,6)), 2) as double) as estimate, 'estimate' as label from lineitem",
)
def estimated_tax(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("tax", reshape.estimated_tax(money("l_extendedprice"), F.col("l_tax").cast("decimal(9,6)"), F.year("l_shipdate")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.col("tax.taxable").cast("double").alias("taxable"), F.col("tax.rate").cast("double").alias("rate"), "tax.rate_year", F.col("tax.estimate").cast("double").alias("estimate"), "tax.label")
