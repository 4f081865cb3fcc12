"""Row and cross-row validation. Diagnostics carry codes, fields and row numbers, never a source value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from parcelwright.functions import text as t


def header_diagnostics(headers: DataFrame, required: list[str]) -> DataFrame:
    """(member, code, name) for headers (member, position, name): blank, duplicate, colliding, missing, and extra names.

    One job judges all members. Names collide when they differ but fold to the same ASCII letters.
    """
    trimmed = headers.withColumn("_t", t.ascii_trim(F.col("name")))
    blank = trimmed.where("_t = ''").select("member", F.lit("blank_header").alias("code"), "name")
    named = trimmed.where("_t <> ''").groupBy("member", "name").agg(F.count("*").alias("n"), F.min("_t").alias("_t"))
    duplicate = named.where("n > 1").select("member", F.lit("duplicate_header").alias("code"), "name")
    folded = named.withColumn("_f", t.ascii_fold(F.col("_t")))
    several = folded.groupBy("member", "_f").agg(F.count("*").alias("k")).where("k > 1")
    collide = folded.join(several, ["member", "_f"], "left_semi").select("member", F.lit("header_name_collision").alias("code"), "name")
    spark = headers.sparkSession
    wanted = spark.createDataFrame([(r,) for r in required], "name string")
    missing = headers.select("member").distinct().crossJoin(wanted).join(named, ["member", "name"], "left_anti").select("member", F.lit("missing_required_header").alias("code"), "name")
    extra = named.join(wanted, "name", "left_anti").select("member", F.lit("extra_columns_present").alias("code"), "name")
    return reduce(DataFrame.unionByName, (blank, duplicate, collide, missing, extra))


def descriptor_diagnostics(observed: DataFrame, contract: DataFrame, attributes: list[str]) -> DataFrame:
    """(table, column, code): a row for each attribute that differs, and for missing and extra columns.

    Both sides have table, column and the attributes, one row for a column.
    """
    o, c = observed.alias("o"), contract.alias("c")
    both = o.join(c, (F.col("o.table") == F.col("c.table")) & (F.col("o.column") == F.col("c.column")), "full_outer")
    differs = [F.when(~F.col(f"o.{a}").eqNullSafe(F.col(f"c.{a}")), f"incompatible_{a}") for a in attributes]
    codes = F.when(F.col("o.column").isNull(), F.array(F.lit("missing_required_column"))).when(F.col("c.column").isNull(), F.array(F.lit("extra_columns_present"))).otherwise(F.array_compact(F.array(*differs)))
    return both.select(F.coalesce("o.table", "c.table").alias("table"), F.coalesce("o.column", "c.column").alias("column"), F.explode(codes).alias("code"))


def layout_gate(members: DataFrame, pinned: DataFrame) -> DataFrame:
    """members with `passes`: fingerprint, the caller's `expected` one, and label are all the pinned ones.

    The live layout is held against the pin first, so a layout that drifts fails whatever its caller claims. Scans are
    planned for passing members only.
    """
    p = pinned.select(F.col("member_kind"), F.col("fingerprint").alias("_f"), F.col("label").alias("_l"))
    ok = F.coalesce((F.col("fingerprint") == F.col("_f")) & (F.col("expected") == F.col("_f")) & (F.col("label") == F.col("_l")), F.lit(False))
    return members.join(p, "member_kind", "left").withColumn("passes", ok).drop("_f", "_l")


def width_diagnostics(lines: DataFrame, width: int) -> DataFrame:
    """(member, physical_row_number, code): rows whose width is not the first row's; the first row if it is short itself.

    A member with a control character gets invalid_source_text diagnostics alone: its widths mean nothing.
    """
    measured = lines.select("member", "physical_row_number", F.length("value").alias("w"), t.has_control(F.col("value")).alias("bad"))
    by = measured.groupBy("member").agg(F.min_by("w", "physical_row_number").alias("w1"), F.bool_or("bad").alias("any_bad"))
    code = F.when(F.col("any_bad"), F.when(F.col("bad"), "invalid_source_text")).when(F.col("w") != F.col("w1"), "record_width_mismatch").when((F.col("physical_row_number") == 1) & (F.col("w") < width), "record_width_mismatch")
    return measured.join(by, "member").select("member", "physical_row_number", code.alias("code")).where("code is not null")


def row_width_diagnostics(rows: DataFrame, line: Column, separator: str, n: int) -> DataFrame:
    """rows with n_fields that is not n; separators inside quoted fields don't count."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return rows.withColumn("n_fields", F.size(F.split(bare, separator, -1))).where(F.col("n_fields") != n)


def validate_rows(rows: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """rows with diagnostics: array of (code, field, ordinal) of the rules (code, field, failing) that fail, in order."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(code).alias("code"), F.lit(field).alias("field"), F.lit(i).alias("ordinal"))) for i, (code, field, bad) in enumerate(rules))))
    return rows.withColumn("diagnostics", found)


def duplicate_keys(rows: DataFrame, key: list[str], order: list, eligible: Column) -> DataFrame:
    """Eligible rows after the first of their key; which rows may hold a key is the source contract's choice."""
    return rows.where(eligible).withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_rank > 1").drop("_rank")


def first_failing_row(diagnostics: DataFrame, by: list[str]) -> DataFrame:
    """The diagnostics of each release's first failing row alone; the minimum is taken by partial aggregation."""
    first = diagnostics.groupBy(*by).agg(F.min("physical_row_number").alias("_first"))
    return diagnostics.join(first, by).where("physical_row_number = _first").drop("_first")


def fact_conflicts(rows: DataFrame, key: list[str], facts: list[str], order: list) -> DataFrame:
    """Rows that differ from the first row of their key, with the first differing fact; the first row sets the facts."""
    w = W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    led = rows.withColumn("_first", F.first(F.struct(*facts)).over(w))
    differs = F.coalesce(*(F.when(~F.col(f).eqNullSafe(F.col(f"_first.{f}")), f) for f in facts))
    return led.withColumn("field", differs).where("field is not null").drop("_first")


def account_group_profile(rows: DataFrame, key: list[str], facts: list[str], owner: list[str]) -> DataFrame:
    """Each key's rows and distinct facts, and whether they are consistent, differ by owner only, or conflict."""
    agg = rows.groupBy(*key).agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*facts)).alias("n_facts"), F.count_distinct(F.struct(*owner)).alias("n_owners"))
    return agg.withColumn("verdict", F.when(F.col("n_facts") > 1, "conflict").when(F.col("n_owners") > 1, "owner_differences").otherwise("consistent"))


def child_orphans(children: DataFrame, parents: DataFrame, key: list[str], core: Column) -> DataFrame:
    """children with `code`: null where the parent is there, blocking for core tables, a warning for others. No row is lost."""
    known = parents.select(*key).distinct().withColumn("_known", F.lit(True))
    code = F.when(F.col("_known").isNull(), F.when(core, "core_child_orphaned").otherwise("legal_child_orphaned"))
    return children.join(known, key, "left").withColumn("code", code).drop("_known")


def orphan_gate(orphans: DataFrame, thresholds: dict[str, int]) -> DataFrame:
    """Orphans by child table against its threshold; a table without one must have none."""
    limit = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in thresholds.items() for x in kv)), F.col("child_table")), F.lit(0)) if thresholds else F.lit(0)
    return orphans.groupBy("child_table").agg(F.count("*").alias("n_children"), F.count_if(F.col("code").isNotNull()).alias("n_orphans")).withColumn("passes", F.col("n_orphans") <= limit)


def record_agreement(records: DataFrame, releases: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """The first of fields in which a record differs from its release, in the given order; null where all agree."""
    other = releases.select(*by, *(F.col(f).alias(f"_r_{f}") for f in fields))
    first = F.coalesce(*(F.when(~F.col(f).eqNullSafe(F.col(f"_r_{f}")), f) for f in fields))
    return records.join(other, by, "left").withColumn("field", first).drop(*(f"_r_{f}" for f in fields))


def family_consistency(rows: DataFrame, year: str, values: list[str]) -> DataFrame:
    """Rows with certified values but no certified year."""
    return rows.where(F.col(year).isNull() & reduce(lambda a, b: a | b, (F.col(v).isNotNull() for v in values)))


def value_hierarchy(rows: DataFrame, lower: str, upper: str, by: list[str]) -> DataFrame:
    """How many rows can be compared, and in how many the lower value exceeds the upper."""
    return rows.groupBy(*by).agg(F.count_if(F.col(lower).isNotNull() & F.col(upper).isNotNull()).alias("n_comparable"), F.count_if(F.col(lower) > F.col(upper)).alias("n_violations"))


def redirect_chain(hops: DataFrame, allowed: DataFrame, most: int, schemes: tuple[str, ...] = ("https",)) -> DataFrame:
    """(chain, hop, code) of hops (chain, hop, from_url, to_url, host, status): scheme, host, status, continuity and length.

    Schemes and hosts are compared without case. The list of hosts is joined, whatever its size.
    """
    w = W.partitionBy("chain").orderBy("hop")
    ok = allowed.select(t.ascii_fold(F.col("host")).alias("_host")).distinct().withColumn("_ok", F.lit(True))
    met = hops.withColumn("_prev", F.lag("to_url").over(w)).withColumn("_host", t.ascii_fold(F.col("host"))).join(ok, "_host", "left")
    scheme = t.ascii_fold(F.regexp_extract("from_url", r"\A([A-Za-z][A-Za-z0-9+.-]*):", 1))
    codes = F.array_compact(F.array(F.when(~scheme.isin(*schemes), "scheme_not_allowed"), F.when(F.col("_ok").isNull(), "host_not_allowed"), F.when(~F.col("status").between(300, 399), "status_not_redirect"), F.when(F.col("_prev").isNotNull() & (F.col("_prev") != F.col("from_url")), "broken_chain"), F.when(F.col("hop") > most, "too_many_redirects")))
    return met.select("chain", "hop", F.explode(codes).alias("code"))


def archive_audit(members: DataFrame, suffixes: list[str], most_bytes: int, most_ratio: float, most_members: int, most_total: int, methods: tuple[int, ...] = (0, 8), most_member_ratio: float | None = None) -> DataFrame:
    """(archive, name, code) of a listing (archive, name, declared, compressed, kind, encrypted, method, readable, intact).

    A row stands for a member; one with readable false stands for a container that gave no listing, and is judged by
    that alone. kind is `file` for regular members, intact is whether a member's bytes met its checksum. Member rules
    go row by row, archive rules (name null) come from one partial aggregation. A member's ratio may be greater
    than the archive's: most_member_ratio, or else most_ratio.
    """
    ratio = F.col("declared") / F.col("compressed")
    suffix = t.ascii_fold(F.regexp_extract("name", r"(\.[^./]+)\z", 1))
    unread = ~F.coalesce(F.col("readable"), F.lit(False))
    too_high = F.when(F.col("compressed") > 0, ratio > (most_member_ratio or most_ratio)).otherwise(F.col("declared") > 0)
    rules = [
        ("path_traversal", F.col("name").rlike(r"(\A|/)\.\.(/|\z)|\A/|\\|\A[A-Za-z]:")),
        ("unsupported_member_type", ~F.col("kind").eqNullSafe("file")),
        ("unsupported_media_type", ~suffix.isin(*suffixes)),
        ("encrypted_member", F.coalesce(F.col("encrypted"), F.lit(True))),
        ("unsupported_compression", ~F.coalesce(F.col("method").isin(*methods), F.lit(False))),
        ("member_too_large", F.col("declared") > most_bytes),
        ("compression_ratio_too_high", too_high),
        ("corrupt_member", ~F.coalesce(F.col("intact"), F.lit(False))),
    ]
    codes = F.when(unread, F.array(F.lit("unreadable_archive"))).otherwise(F.array_compact(F.array(*(F.when(bad, F.lit(code)) for code, bad in rules))))
    rows = members.select("archive", F.when(~unread, F.col("name")).alias("name"), F.explode(codes).alias("code"))
    sums = members.where(~unread).groupBy("archive").agg(F.count("*").alias("n"), F.sum("declared").alias("d"), F.sum("compressed").alias("c"))
    whole = F.array_compact(F.array(F.when(F.col("n") > most_members, "too_many_members"), F.when(F.col("d") > most_total, "expansion_too_large"), F.when(F.col("d") > F.col("c") * most_ratio, "compression_ratio_too_high")))
    return rows.unionByName(sums.select("archive", F.lit(None).cast("string").alias("name"), F.explode(whole).alias("code")))


def member_set_drift(observed: DataFrame, expected: DataFrame, key: list[str]) -> DataFrame:
    """(key, n, code): members that are missing, unexpected or duplicated."""
    seen = observed.groupBy(*key).agg(F.count("*").alias("n"))
    both = seen.join(expected.select(*key).distinct().withColumn("_e", F.lit(True)), key, "full_outer")
    code = F.when(F.col("n").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(F.col("n") > 1, "duplicated")
    return both.select(*key, F.coalesce("n", F.lit(0)).alias("n"), code.alias("code")).where("code is not null")


def exactly_one_member(observed: DataFrame, expected: DataFrame, key: list[str]) -> DataFrame:
    """(key, n, resolved): how many members each expected table has; it is resolved by one, not by none or several."""
    seen = observed.groupBy(*key).agg(F.count("*").alias("_n"))
    wanted = expected.select(*key).distinct()
    n = F.coalesce("_n", F.lit(0))
    return wanted.join(seen.select(*(F.col(k).alias(f"_s_{k}") for k in key), "_n"), reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in key)), "left").select(*key, n.alias("n"), (n == 1).alias("resolved"))


def constraint_violations(df: DataFrame, checks: dict[str, Column], keep: list[str]) -> DataFrame:
    """A row for each check that is false for a row; null counts as satisfied, as in SQL."""
    failed = F.array_compact(F.array(*(F.when(~c, F.lit(k)) for k, c in checks.items())))
    return df.select(*keep, F.explode(failed).alias("violation"))


def lineage_violations(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Children whose whole composite key no parent has."""
    return child.join(parent.select(*key), key, "left_anti")


def provenance_mismatch(df: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> Column:
    """Names of the pairs that differ, nulls compared as values."""
    return F.array_compact(F.array(*(F.when(~a.eqNullSafe(b), F.lit(k)) for k, (a, b) in pairs.items())))
