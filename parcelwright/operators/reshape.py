"""Source rows into records: typed long values, pivots, roll splits and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelwright.functions import text as t


def native_values(rows: DataFrame, ids: list[str], fields: dict[str, str]) -> DataFrame:
    """One row for each present value: source_field, lexical_text and its typed columns.

    fields maps a column to text, integer or numeric. Absent and blank values give no row; an observed value
    has exactly one of text_value, integer_value and numeric_value, and numerics have precision and scale.
    A narrow explode: nothing is shuffled.
    """
    kinds = dict(rows.dtypes)

    def entry(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        size = kinds[name].partition("(")[2].rstrip(")").split(",") if kind == "numeric" else None
        return F.struct(
            F.lit(name).alias("source_field"),
            c.cast("string").alias("lexical_text"),
            (c if kind == "text" else F.lit(None)).cast("string").alias("text_value"),
            (c if kind == "integer" else F.lit(None)).cast("long").alias("integer_value"),
            (c if kind == "numeric" else F.lit(None)).cast("decimal(38,10)").alias("numeric_value"),
            F.lit(int(size[0]) if size else None).cast("int").alias("numeric_precision"),
            F.lit(int(size[1]) if size else None).cast("int").alias("numeric_scale"),
        )

    entries = F.filter(F.array(*(entry(k, v) for k, v in fields.items())), lambda x: t.ascii_trim(x["lexical_text"]) != "")
    return rows.select(*ids, F.explode(entries).alias("_v")).select(*ids, "_v.*")


def exactly_one_value() -> Column:
    """Whether a long value row has one typed value, and precision and scale with a numeric only."""
    n = sum((F.col(c).isNotNull().cast("int") for c in ("text_value", "integer_value", "numeric_value")), F.lit(0))
    sized = F.col("numeric_precision").isNotNull() & F.col("numeric_scale").isNotNull()
    return (n == 1) & (sized == F.col("numeric_value").isNotNull())


def non_sensitive(rows: DataFrame, allowed: list[str], sensitive: list[str]) -> DataFrame:
    """The allowed columns; a sensitive one among them is an error before any row is read."""
    if clash := sorted(set(allowed) & set(sensitive)):
        raise ValueError(f"sensitive columns may not be projected: {clash}")
    return rows.select(*allowed)


def estimated_tax(taxable: Column, rate: Column, rate_year: Column) -> Column:
    """struct(taxable, rate, rate_year, estimate, label): an estimate that keeps its inputs, never an amount due."""
    return F.struct(taxable.alias("taxable"), rate.alias("rate"), rate_year.alias("rate_year"), F.round(taxable * rate, 2).alias("estimate"), F.lit("estimate").alias("label"))


def shared_records(rows: DataFrame, account: str, identifiers: dict[str, str], values: list[str], status: str | None = None, year: str | None = None) -> DataFrame:
    """One shared record for each source row, at its grain: account, year, status, identifier and value maps.

    Blank values are absent from the maps; nothing is summed or merged.
    """
    pick = lambda names: F.map_filter(F.map_from_arrays(F.array(*(F.lit(k) for k in names)), F.array(*(F.col(f"`{c}`").cast("string") for c in names.values()))), lambda k, v: t.ascii_trim(v) != "")
    return rows.select(
        F.col(account).cast("string").alias("account_id"),
        (F.col(year) if year else F.lit(None)).cast("int").alias("appraisal_year"),
        (F.col(status) if status else F.lit(None)).cast("string").alias("source_status"),
        pick(identifiers).alias("identifiers"),
        pick({v: v for v in values}).alias("native_values"),
        *[c for c in rows.columns if c.startswith("_")],
    )


def dual_roll_split(rows: DataFrame, current: dict[str, str], certified: dict[str, str], certified_year: str) -> DataFrame:
    """A current observation of each row, and a certified one where its year and any certified value are there.

    current and certified map value names to columns; the two families never fill each other.
    """
    pack = lambda names: F.struct(*(F.col(c).alias(k) for k, c in names.items()))
    has = F.col(certified_year).isNotNull() & F.greatest(*(F.col(c).isNotNull() for c in certified.values()), F.lit(False))
    both = F.array(F.struct(F.lit("current").alias("family"), pack(current).alias("v")), F.when(has, F.struct(F.lit("certified").alias("family"), pack(certified).alias("v"))))
    return rows.withColumn("_o", F.explode(F.filter(both, lambda x: x.isNotNull()))).select(*rows.columns, "_o.family", "_o.v.*")


def pivot_values(long: DataFrame, ids: list[str], fields: list[str], value: str = "lexical_text") -> DataFrame:
    """One row for each id with a column for each of fields; the list is fixed, so no pass finds it out."""
    return long.groupBy(*ids).pivot("source_field", fields).agg(F.max(value))


def retain_extras(rows: DataFrame, required: list[str]) -> DataFrame:
    """The required columns, all others as a map keyed by normalized header, and a warning for each of these, by name."""
    extra = [c for c in rows.columns if c not in required]
    keys = F.array(*(t.normalize_header(F.lit(c)) for c in sorted(extra))) if extra else F.array().cast("array<string>")
    vals = F.array(*(F.col(f"`{c}`").cast("string") for c in sorted(extra))) if extra else F.array().cast("array<string>")
    return rows.select(*required, F.map_from_arrays(keys, vals).alias("extras"), F.transform(F.array_sort(keys), lambda k: F.struct(F.lit("extra_columns_present").alias("code"), k.alias("field_name"))).alias("warnings"))


def unpivot_taxable(rows: DataFrame, ids: list[str], columns: dict[str, str]) -> DataFrame:
    """A row for each taxing unit's value; several stay several, none is picked."""
    entries = F.array(*(F.struct(F.lit(k).alias("unit"), F.col(c).alias("taxable")) for k, c in columns.items()))
    return rows.select(*ids, F.explode(F.filter(entries, lambda x: x["taxable"].isNotNull())).alias("_t")).select(*ids, "_t.*")
