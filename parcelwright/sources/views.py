"""The given tables seen as appraisal rolls, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The counties of the cohort (number, slug, state, FIPS code, ready for production).
COUNTIES = (
    (0, "dallas", "TX", "48113", True),
    (1, "collin", "TX", "48085", True),
    (2, "tarrant", "TX", "48439", True),
    (3, "denton", "TX", "48121", True),
    (4, "ellis", "TX", "48139", True),
    (5, "rockwall", "TX", "48397", False),
)

COUNTIES_SQL = "counties(county, slug, state, fips, ready) as (values " + ", ".join(f"({i}, '{s}', '{t}', '{f}', {str(r).lower()})" for i, s, t, f, r in COUNTIES) + ")"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counties(spark: SparkSession) -> DataFrame:
    """Six rows; always safe to broadcast."""
    return spark.createDataFrame(COUNTIES, "county int, slug string, state string, fips string, ready boolean")


def money(c: Column | str) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a roll: one account a row, with county, tax year and release kind."""
    o = table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "P", "proposed").when(F.col("o_orderstatus") == "F", "certified").otherwise("certified-with-supplemental")
    return o.select(
        F.lpad(F.col("o_orderkey").cast("string"), 17, "0").alias("account_id"),
        (F.col("o_custkey") % 6).cast("int").alias("county"),
        F.year("o_orderdate").alias("tax_year"),
        kind.alias("release_kind"),
        money("o_totalprice").alias("value"),
        "o_orderkey",
        "o_custkey",
        F.to_date("o_orderdate").alias("as_of"),
        "o_orderpriority",
    )


ACCOUNTS_SQL = """accounts as (
  select lpad(cast(o_orderkey as varchar), 17, '0') as account_id, cast(o_custkey % 6 as int) as county, cast(year(o_orderdate) as int) as tax_year,
         case o_orderstatus when 'P' then 'proposed' when 'F' then 'certified' else 'certified-with-supplemental' end as release_kind,
         cast(o_totalprice as decimal(18,2)) as value, o_orderkey, o_custkey, cast(o_orderdate as date) as as_of, o_orderpriority
  from orders)"""

#: Columns that order lineitem rows totally; equal rows are interchangeable.
ROW_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def owner_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as owner rows: property, owner sequence, and facts that a property's rows should share."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("prop_id"), F.col("l_linenumber").alias("owner_sequence"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.year("l_shipdate").alias("tax_year"), *ROW_ORDER)


OWNER_ROWS_SQL = f"""owner_rows as (
  select l_orderkey as prop_id, l_linenumber as owner_sequence, l_returnflag as flag, l_linestatus as status, cast(year(l_shipdate) as int) as tax_year, {", ".join(ROW_ORDER)}
  from lineitem)"""
ROW_ORDER_SQL = ", ".join(ROW_ORDER)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as archive members: archive, name, declared size and compressed size."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("archive"),
        F.concat_ws("/", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("name"),
        F.col("n_chars").alias("declared"),
        F.expr("1 + n_chars div (1 + doc_id % 7)").alias("compressed"),
        "lang",
        "doc_id",
    )


MEMBERS_SQL = "members as (select source as archive, lang || '/' || doc_id || '.txt' as name, n_chars as declared, 1 + n_chars // (1 + doc_id % 7) as compressed, lang, doc_id from documents)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as observations of a remote file: entity, time, signature, and whether it is valid."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("entity"), "ts", "event_id", F.col("event_type").alias("signature"), (F.col("event_type") != "error").alias("valid"), "value")


OBSERVATIONS_SQL = "observations as (select user_id as entity, ts, event_id, event_type as signature, event_type <> 'error' as valid, value from events)"
