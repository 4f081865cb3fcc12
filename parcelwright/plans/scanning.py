"""Files rendered from the tables, written, and scanned again; artifacts and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwright.operators import storage
from parcelwright.plans.registry import query
from parcelwright.sources import files, scan, workspace
from parcelwright.sources.views import money, table
from parcelwright.streaming import intake

#: Positions of the fixed-width account lines (name, first, last), and the width.
LAYOUT = [("account_id", 1, 17), ("county", 18, 18), ("tax_year", 19, 22), ("value", 23, 40), ("priority", 41, 56)]
WIDTH = 56
SUPPLIER_FIELDS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]


def rendered(spark, sf_dir, ending="", extra=None):
    """orders as ISO-8859-1 fixed-width lines with an accented letter, written as text files; returns their folder."""
    o = table(spark, sf_dir, "orders")
    line = F.concat(
        F.lpad(F.col("o_orderkey").cast("string"), 17, "0"),
        (F.col("o_custkey") % 6).cast("string"),
        F.year("o_orderdate").cast("string"),
        F.lpad(money("o_totalprice").cast("string"), 18, " "),
        F.rpad(F.concat(F.lit("é"), F.col("o_orderpriority")), 16, " "),
        extra if extra is not None else F.lit(""),
        F.lit(ending),
    )
    path = workspace.new_path(spark, "lines")
    o.select(F.encode(line, "ISO-8859-1").cast("string").alias("value")).write.text(path)
    return path


@query("scan_latin1_lines", "select lpad(cast(o_orderkey as varchar), 17, '0') || cast(o_custkey % 6 as varchar) || cast(year(o_orderdate) as varchar) || lpad(cast(cast(o_totalprice as decimal(18,2)) as varchar), 18, ' ') || rpad('é' || o_orderpriority, 16, ' ') as line from orders")
def scan_latin1_lines(spark, sf_dir):
    """Every line as it was written, without the carriage return before its end."""
    return scan.scan_lines(spark, rendered(spark, sf_dir, "\r")).select(F.col("value").alias("line"))


@query("physical_row_number", "select year(o_orderdate) * 100 + month(o_orderdate) as member, lpad(cast(o_orderkey as varchar), 17, '0') as account_id, row_number() over (partition by year(o_orderdate), month(o_orderdate) order by o_orderkey) as physical_row_number from orders")
def physical_row_number(spark, sf_dir):
    """A file for each month of orders, written in the order of their keys; each line with its number in its file."""
    path = workspace.new_path(spark, "months")
    o = table(spark, sf_dir, "orders").select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month"), F.lpad(F.col("o_orderkey").cast("string"), 17, "0").alias("value"))
    o.repartition("month").sortWithinPartitions("month", "value").write.partitionBy("month").text(path)
    rows = scan.with_row_numbers(scan.scan_lines(spark, path))
    return rows.select(F.regexp_extract("member", "month=([0-9]+)/", 1).cast("int").alias("member"), F.col("value").alias("account_id"), "physical_row_number")


@query("scan_fixed_width", "select lpad(cast(o_orderkey as varchar), 17, '0') as account_id, cast(o_custkey % 6 as varchar) as county, cast(year(o_orderdate) as varchar) as tax_year, cast(cast(o_totalprice as decimal(18,2)) as varchar) as value, 'é' || o_orderpriority as priority from orders")
def scan_fixed_width(spark, sf_dir):
    return scan.slice_fixed_width(scan.scan_lines(spark, rendered(spark, sf_dir)), LAYOUT, [])


@query("trailing_region", "select lpad(cast(o_orderkey as varchar), 17, '0') as account_id, case when o_orderkey % 3 > 0 then length(o_orderpriority) end as bytes, case when o_orderkey % 3 > 0 then sha256(o_orderpriority) end as sha256 from orders")
def trailing_region(spark, sf_dir):
    lines = scan.scan_lines(spark, rendered(spark, sf_dir, extra=F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).otherwise("")))
    rest = scan.trailing_region(F.col("value"), WIDTH)
    return lines.select(F.substring("value", 1, 17).alias("account_id"), rest["bytes"].alias("bytes"), rest["sha256"].alias("sha256"))


@query("scan_delimited_csv", """select cast(c_custkey as varchar) as c_custkey, 'The "' || c_name || '", Inc' || chr(10) || 'x' as c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment as segment from customer""")
def scan_delimited_csv(spark, sf_dir):
    path = workspace.new_path(spark, "csv")
    c = table(spark, sf_dir, "customer")
    name = F.concat(F.lit('The "'), "c_name", F.lit('", Inc\nx'))
    c.select(F.col("c_mktsegment").alias(" Segment "), F.col("c_custkey").alias("c_CustKey"), name.alias("C_NAME\t"), "c_nationkey").write.option("quote", '"').option("escape", '"').option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path, header=True)
    return scan.scan_csv(spark, path, ["c_custkey", "c_name", "c_nationkey"]).where("_corrupt is null").select("c_custkey", "c_name", "c_nationkey", F.col("SEGMENT").alias("segment"))


@query(
    "scan_pipe_delimited",
    """select s_suppkey as key, case s_suppkey % 5 when 2 then 'malformed_delimited_record' when 3 then 'row_width_mismatch' end as code,
      case when s_suppkey % 5 in (0, 4) then s_name when s_suppkey % 5 = 1 then 'a "b" | ' || s_name end as s_name,
      case when s_suppkey % 5 not in (2, 3) then cast(s_nationkey as varchar) end as s_nationkey, case when s_suppkey % 5 not in (2, 3) then cast(cast(s_acctbal as decimal(18,2)) as varchar) end as s_acctbal from supplier""",
)
def scan_pipe_delimited(spark, sf_dir):
    """Suppliers as pipe-delimited lines; of five, one is quoted, one has text behind a quote, one lacks a field."""
    k = F.col("s_suppkey") % 5
    name = F.when(k == 1, F.concat(F.lit('"a ""b"" | '), "s_name", F.lit('"'))).when(k == 2, F.concat(F.lit('"'), "s_name", F.lit('"junk'))).otherwise(F.col("s_name"))
    tail = F.when(k == 3, F.lit("")).otherwise(F.concat(F.lit("|"), money("s_acctbal").cast("string")))
    path = workspace.new_path(spark, "pipe")
    table(spark, sf_dir, "supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit("|"), name, F.lit("|"), F.col("s_nationkey").cast("string"), tail).alias("value")).write.text(path)
    lines = workspace.written(scan.with_row_numbers(scan.scan_lines(spark, path)), "numbered")
    met = scan.scan_pipe(lines, SUPPLIER_FIELDS).join(lines, ["member", "physical_row_number"])
    return met.select(F.regexp_extract("value", r"\A([0-9]+)", 1).cast("long").alias("key"), "code", "s_name", "s_nationkey", "s_acctbal")


@query(
    "content_inventory",
    """with f as (select doc_id % 97 as bucket, coalesce(string_agg(text || chr(10), '' order by doc_id), '') as content from documents group by 1),
    g as (select bucket, content from f union all select 97, content from f where bucket = 0 union all select * from (values (98, ''), (99, '')))
    select sha256(content) as sha256, count(*) as n, min(bucket)::int as locator, min(strlen(content)) as byte_count from g group by content""",
)
def content_inventory(spark, sf_dir):
    """Documents as 97 files, one of them twice, and two empty files; each is hashed in chunks of 64 KB."""
    path = workspace.new_path(spark, "artifacts")
    d = table(spark, sf_dir, "documents").where("text is not null").select((F.col("doc_id") % 97).cast("int").alias("bucket"), "doc_id", F.col("text").alias("value"))
    d = d.withColumn("bucket", F.explode(F.when(F.col("bucket") == 0, F.array(F.lit(0), F.lit(97))).otherwise(F.array("bucket"))))
    d.repartition("bucket").sortWithinPartitions("bucket", "doc_id").drop("doc_id").write.partitionBy("bucket").text(path)
    for bucket in (98, 99):
        spark.range(0, 0, 1, 1).select(F.lit("").alias("value")).coalesce(1).write.text(f"{path}/bucket={bucket}")
    found = storage.content_inventory(spark, path, chunk_bytes=1 << 16)
    number = F.regexp_extract("member", r"bucket=([0-9]+)/", 1).cast("int")
    least = files.digests(files.listing(spark, path)).groupBy("sha256").agg(F.min(number).alias("locator"))
    return found.drop("locator").join(least, "sha256").select("sha256", "n", "locator", "byte_count")


@query("silver_sink_idempotent", "select distinct l_orderkey, l_linenumber, case when l_returnflag = 'N' then null else l_returnflag end as family from lineitem")
def silver_sink_idempotent(spark, sf_dir):
    """A quarter of the records is appended, then all, then all again: the table holds every key once, nulls not distinct."""
    key = ["l_orderkey", "l_linenumber", "family"]
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_returnflag")).alias("family"))
    path = workspace.new_path(spark, "silver")
    for part in (x.where("l_orderkey % 4 = 3"), x, x):
        storage.append_records(part, path, key)
    return spark.read.schema(x.schema).parquet(path)


@query(
    "bulk_export_manifest",
    """select cast(o_custkey % 6 as int) as county, cast(year(o_orderdate) as int) as tax_year, count(*) as n_rows,
      cast(sum(cast('0x' || substr(sha256('{"county":"' || (o_custkey % 6) || '","o_orderkey":"' || o_orderkey || '","tax_year":"' || year(o_orderdate) || '","value":"' || cast(o_totalprice as decimal(18,2)) || '"}'), 1, 12) as bigint)) as varchar) as checksum,
      ceil(count(*) / 100)::bigint > 1 as split, 0 as n_faults from orders group by 1, 2""",
)
def bulk_export_manifest(spark, sf_dir):
    """An export in files of about 100 rows; checksums of its files, added up by partition, and what a second reading finds against the manifest."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 6).cast("int").alias("county"), F.year("o_orderdate").alias("tax_year"), "o_orderkey", money("o_totalprice").alias("value"))
    path = workspace.new_path(spark, "export")
    made = workspace.written(storage.bulk_export(o, path, ["county", "tax_year"], rows_per_file=100), "manifest")
    faults = storage.manifest_faults(made, storage.manifest(spark, path, o.schema, ["county", "tax_year"])).groupBy().agg(F.count("*").cast("int").alias("n_faults"))
    sums = made.groupBy("county", "tax_year").agg(F.sum("n_rows").alias("n_rows"), F.sum("checksum").cast("decimal(30,0)").cast("string").alias("checksum"), (F.count("*") > 1).alias("split"))
    return sums.crossJoin(F.broadcast(faults))  # one row


@query(
    "quarantine_sink",
    "with r as (select o_custkey % 6 as county, year(o_orderdate) as y, bool_and(o_orderkey % 997 <> 0) as accepted, count(*) as n from orders group by all) select accepted, count(*) as n_releases, sum(n)::bigint as n_records from r group by 1",
)
def quarantine_sink(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 6).alias("county"), F.year("o_orderdate").alias("y"), "o_orderkey")
    outcomes = o.groupBy("county", "y").agg(F.every(F.col("o_orderkey") % 997 != 0).alias("accepted"))
    good, bad = storage.split_quarantine(o, outcomes, ["county", "y"])
    folder = workspace.new_path(spark, "split")
    good.write.parquet(f"{folder}/accepted=true")
    bad.write.parquet(f"{folder}/accepted=false")
    back = spark.read.schema("county long, y int, o_orderkey long, accepted boolean").parquet(folder)
    return back.groupBy("accepted").agg(F.count_distinct("county", "y").alias("n_releases"), F.count("*").alias("n_records"))


@query(
    "incremental_release_intake",
    """with f as (select o_custkey % 50 as p, 1 as delivery from orders where o_custkey % 50 < 40 group by 1 union all select o_custkey % 50, 2 from orders group by 1),
      s as (select f.*, p % 5 = 0 and delivery = 2 as other from f)
    select p::int as partition_key, delivery, case when delivery = 1 or p >= 40 then 'NEW' when other then 'DIVERGED' else 'IDENTICAL' end as classification,
      case when delivery = 2 and p < 40 and not other then 0 else n end as n_taken
    from s join (select o_custkey % 50 as p, count(*) as n from orders group by 1) using (p)""",
)
def incremental_release_intake(spark, sf_dir):
    """Two deliveries of files, a file a partition: of the second, some bring the bytes of the first again, some other bytes. The stream
    runs once more without anything new. The ledger has every delivery, the target the rows of new and diverged ones."""
    folder = workspace.new_path(spark, "intake")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 50).cast("int").alias("p"))
    taker = intake.Intake(spark, f"{folder}/out", f"{folder}/ledger", r"/p=([0-9]+)/")
    for delivery in (1, 2):
        lines = F.concat_ws("|", F.col("o_orderkey").cast("string"), money("o_totalprice").cast("string"), F.when((F.col("p") % 5 == 0) & (F.lit(delivery) == 2), "x"))
        rows = (o.where("p < 40") if delivery == 1 else o).select("p", "o_orderkey", lines.alias("value"))
        rows.repartition("p").sortWithinPartitions("p", "o_orderkey").drop("o_orderkey").write.mode("append").partitionBy("p").text(f"{folder}/in/delivery={delivery}")
        taker.run(f"{folder}/in/delivery=*/p=*", f"{folder}/state")
    taker.run(f"{folder}/in/delivery=*/p=*", f"{folder}/state")
    ledger, taken = taker.ledger(), taker.taken()
    number = F.regexp_extract("member", r"/delivery=([0-9]+)/", 1).cast("int").alias("delivery")
    counts = taken.groupBy("member").agg(F.count("*").alias("n_taken"))
    return ledger.join(counts, "member", "left").select(F.col("partition_key").cast("int").alias("partition_key"), number, "classification", F.coalesce("n_taken", F.lit(0)).cast("long").alias("n_taken"))
