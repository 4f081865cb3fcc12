"""Quality rules as rows: families of checks whose subjects and thresholds come from a rule table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

#: The families that a rule may belong to.
FAMILIES = (
    "required_key_completeness", "logical_uniqueness", "child_relationship", "schema_compatibility",
    "record_count_drift", "value_validity", "archive_completeness", "source_specific",
)
RULES = "rule_id string, version int, severity string, rule_family string, subject string, threshold string, active boolean"
#: Rules are configuration; a table of more is refused, since each is an aggregate of one pass.
MOST_RULES = 2_000


def _rows(rules: DataFrame) -> list[dict]:
    """Active rules, each in its newest version, checked as a whole before anything is measured."""
    found = [r.asDict() for r in rules.select(*(c.split()[0] for c in RULES.split(", "))).limit(MOST_RULES + 1).collect()]
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    newest = {}
    for r in found:
        if r["rule_family"] not in FAMILIES or r["severity"] not in ("blocking", "warning") or not isinstance(limits := json.loads(r["threshold"]), dict):
            raise ValueError(f"rule {r['rule_id']} is not well formed")
        if r["version"] >= newest.get((r["rule_id"], r["subject"]), r)["version"]:
            newest[r["rule_id"], r["subject"]] = r | {"limits": limits}
    return [r for r in newest.values() if r["active"]]


def _row_measure(rule: dict, key: list[str]) -> Column:
    """What a rule over a run's rows measures: a number that should not exceed the rule's `most`."""
    family, subject, limits = rule["rule_family"], rule["subject"], rule["limits"]
    if family == "required_key_completeness":
        return F.count_if(F.col(subject).isNull() | (F.col(subject).cast("string") == "")).cast("double")
    if family == "logical_uniqueness":
        return (F.count("*") - F.count_distinct(F.struct(*key))).cast("double")
    if family == "value_validity":
        low, high = (F.lit(str(limits[k])).cast("decimal(38,6)") if k in limits else None for k in ("low", "high"))
        bad = F.lit(False)
        bad = bad | (F.col(subject) < low) if low is not None else bad
        bad = bad | (F.col(subject) > high) if high is not None else bad
        return F.try_divide(F.count_if(bad), F.count("*")).cast("double")
    return F.count_if(~F.coalesce(F.expr(limits["holds"]), F.lit(False))).cast("double")  # source_specific: a predicate that rows should meet


def evaluate(rows: DataFrame, run: list[str], key: list[str], rules: DataFrame, previous: DataFrame | None = None, children: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """(run, rule_id, version, subject, measured, expected, passed): a row for each run and active rule, passing or not.

    rules is a table (RULES); threshold is a JSON object with `most`, the greatest value that passes, and a family's own settings.
    rows: the runs' records. previous: run and n_before, for record_count_drift. children: run, child_table and orphaned, for
    child_relationship (subject: a table; measured: the share of orphans). members: run and member, for archive_completeness (subject: an expected
    member; measured: one if it is absent). schema_compatibility (subject: name and type, as `value decimal(18,2)`) is one where the
    rows' column is not of that type. A rule that lacks what it measures fails.

    All rules over rows share one pass; the other families are partial aggregates of their own inputs.
    """
    wanted = _rows(rules)
    types = {name: kind for name, kind in rows.dtypes}
    over_rows, fixed, drift, over_children, over_members = [], [], [], [], []
    for i, rule in enumerate(wanted):
        family = rule["rule_family"]
        if family == "schema_compatibility":
            name, kind = rule["subject"].split(" ", 1)
            fixed.append((i, float(types.get(name) != kind)))
        elif family == "record_count_drift":
            drift.append(i)
        elif family == "child_relationship":
            over_children.append(i)
        elif family == "archive_completeness":
            over_members.append(i)
        else:
            over_rows.append(i)
    wide = rows.groupBy(*run).agg(F.count("*").alias("_n"), *(_row_measure(wanted[i], key).alias(f"_m{i}") for i in over_rows))
    for i, value in fixed:
        wide = wide.withColumn(f"_m{i}", F.lit(value))
    if drift:
        before = previous.select(*run, "n_before") if previous is not None else None
        wide = wide.join(before, run, "left") if before is not None else wide.withColumn("n_before", F.lit(None).cast("long"))
        for i in drift:
            wide = wide.withColumn(f"_m{i}", F.abs(F.try_divide(F.col("_n"), F.col("n_before")) - 1))
    if over_children:
        share = lambda i: F.try_divide(F.count_if((F.col("child_table") == wanted[i]["subject"]) & F.col("orphaned")), F.count_if(F.col("child_table") == wanted[i]["subject"])).cast("double")
        wide = wide.join(children.groupBy(*run).agg(*(share(i).alias(f"_m{i}") for i in over_children)), run, "left") if children is not None else _absent(wide, over_children)
    if over_members:
        absent = lambda i: (F.count_if(F.col("member") == wanted[i]["subject"]) == 0).cast("double")
        wide = wide.join(members.groupBy(*run).agg(*(absent(i).alias(f"_m{i}") for i in over_members)), run, "left") if members is not None else _absent(wide, over_members)
    entry = lambda i, r: F.struct(F.lit(r["rule_id"]).alias("rule_id"), F.lit(r["version"]).alias("version"), F.lit(r["subject"]).cast("string").alias("subject"), F.col(f"_m{i}").cast("double").alias("measured"), F.lit(float(r["limits"]["most"])).alias("expected"))
    entries = F.array(*(entry(i, r) for i, r in enumerate(wanted)))
    long = wide.select(*run, F.explode(entries).alias("e")).select(*run, "e.*")
    return long.withColumn("passed", F.coalesce(F.col("measured") <= F.col("expected"), F.lit(False)))


def _absent(wide: DataFrame, which: list[int]) -> DataFrame:
    return wide.withColumns({f"_m{i}": F.lit(None).cast("double") for i in which})
