"""Literal cases that the tables do not hold: bytes, quotes, line ends, number buffers, odd values."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelwright.functions import text as t
from parcelwright.operators import match, publish, release, reshape, storage, validate
from parcelwright.sources import scan


def member(tmp_path, data, name="m.txt"):
    (tmp_path / name).write_bytes(data)
    return f"file://{tmp_path}/{name}"


def values(spark, path):
    return [r.value for r in scan.with_row_numbers(scan.scan_lines(spark, path)).orderBy("physical_row_number").collect()]


@pytest.mark.parametrize(
    "data, want",
    [(b"a\nb\n", ["a", "b"]), (b"a\r\nb\r\n", ["a", "b"]), (b"a\rb\nc", ["a\rb", "c"]), (b"\xe9\xff\n\n x \n", ["éÿ", "", " x "]), (b"", [])],
)
def test_lines(spark, tmp_path, data, want):
    assert values(spark, member(tmp_path, data)) == want


def test_bom_is_found(spark, tmp_path):
    assert scan.has_bom(spark, member(tmp_path, b"\xef\xbb\xbfa\nb\n")).count() == 1
    assert scan.has_bom(spark, member(tmp_path, b"a\nb\n", "n.txt")).count() == 0


def test_row_numbers_over_splits(spark, tmp_path):
    path = member(tmp_path, b"".join(b"%07d\n" % i for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        rows = scan.with_row_numbers(scan.scan_lines(spark, path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 20_000 and all(int(r.value) + 1 == r.physical_row_number for r in rows)


PIPE = [
    (b'1|"a|b"|2', {1: None}),
    (b'1|"a""|b"|2', {1: None}),
    (b'1|"a"x|2', {1: "malformed_delimited_record"}),
    (b'1|"a\nb"|2\n3|c|4', {1: "multiline_record_unsupported", 3: None}),
    (b'1|"a\nb\nc', {1: "malformed_delimited_record"}),
    (b"1|2\n1|b|3", {1: "row_width_mismatch", 2: None}),
    (b'1|a"b|2\n3|b|4', {1: "malformed_delimited_record", 2: None}),
]


@pytest.mark.parametrize("data, want", PIPE)
def test_pipe_codes(spark, tmp_path, data, want):
    rows = scan.scan_pipe(scan.with_row_numbers(scan.scan_lines(spark, member(tmp_path, data + b"\n"))), ["x", "y", "z"]).collect()
    assert {r.physical_row_number: r.code for r in rows} == want


def test_pipe_values(spark, tmp_path):
    rows = scan.scan_pipe(scan.with_row_numbers(scan.scan_lines(spark, member(tmp_path, b'1|"a""|b"|2\n'))), ["x", "y", "z"]).collect()
    assert (rows[0].x, rows[0].y, rows[0].z) == ("1", 'a"|b', "2")


def test_csv_headers(spark, tmp_path):
    path = member(tmp_path, '﻿TOT_VAL, account_num ,extra\n-001.20,00012,"a ""q"", \nb"\n'.encode())
    row = scan.scan_csv(spark, path, ["ACCOUNT_NUM", "TOT_VAL"]).first()
    assert (row.ACCOUNT_NUM, row.TOT_VAL, row.EXTRA) == ("00012", "-001.20", 'a "q", \nb')
    with pytest.raises(ValueError, match="missing_required_header"):
        scan.scan_csv(spark, path, ["GIS_PARCEL_ID"])
    with pytest.raises(ValueError, match="duplicate"):
        scan.scan_csv(spark, member(tmp_path, b"a,A\n1,2\n", "d.csv"), ["a"])


#: Number buffers with precision, scale and what they hold.
BUFFERS = [
    ("0000000000000000000000000000000000", 1, 0, Decimal(0)),
    ("00000000000000000000000000" + "2a000000", 2, 0, Decimal(42)),
    ("01000000000000000000000000" + "2a000000", 2, 0, Decimal(-42)),
    ("00000000000000000000000000" + "39300000", 5, 2, Decimal("123.45")),
    ("010000000000000000" + "0100000001000000", 10, 2, Decimal("-42949672.97")),
    ("0000000000" + "5ece4f206102253effffff0f", 28, 0, Decimal("9999999999999999999999999999")),
    ("000000000000000000" + "02000000351cdcdf", 13, 2, Decimal("123456789.01")),
]


@pytest.mark.parametrize("buffer, precision, scale, want", BUFFERS)
def test_number_buffers(spark, buffer, precision, scale, want):
    df = spark.createDataFrame([(bytes.fromhex(buffer),)], "b binary")
    got = df.select(t.decode_numeric(F.col("b"), F.lit(precision), scale).alias("x")).first().x
    assert got.code is None and got.value == want


@pytest.mark.parametrize(
    "buffer, precision, code",
    [("00", 4, "invalid_numeric_buffer"), ("02" + "00" * 16, 4, "invalid_numeric_sign"), ("00" * 17, 29, "invalid_numeric_precision"), ("01" + "00" * 16, 4, "negative_zero"), ("0001000000" + "00" * 12, 28, "numeric_precision_overflow"), ("00" * 13 + "10270000", 4, "numeric_precision_overflow")],
)
def test_bad_number_buffers(spark, buffer, precision, code):
    df = spark.createDataFrame([(bytes.fromhex(buffer),)], "b binary")
    assert df.select(t.decode_numeric(F.col("b"), F.lit(precision), 0).alias("x")).first().x.code == code


@pytest.mark.parametrize("value, kind, code", [("1.2345", "four_places", None), ("1.23456", "four_places", "bad_grammar"), ("1e5", "signed", "bad_grammar"), ("-001.20", "signed", None), ("1" * 40, "signed", "unsupported_width"), ("100.000001", "percent", "out_of_range"), (" 12 ", "two_places", None), (None, "signed", None), ("1.\n", "signed", "bad_grammar")])
def test_decimals(spark, value, kind, code):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(t.exact_decimal(F.col("v"), kind).alias("x")).first().x.code == code


@pytest.mark.parametrize("value, want", [("2/29/2024", True), ("02/29/2024", True), ("2/29/2025", False), ("1/1/1899", False), ("2024-01-01", False), ("1/1/2024\n", False)])
def test_dates(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(t.is_date(F.col("v")).alias("x")).first().x is want


def test_identifiers_refuse_a_trailing_newline(spark):
    df = spark.createDataFrame([("a.b-c",), ("a\n",), (".a",), ("",)], "v string")
    assert [r.x for r in df.select(t.matches(F.col("v"), t.IDENTIFIER).alias("x")).collect()] == [True, False, False, False]


def test_null_keys_are_not_distinct(spark):
    old = spark.createDataFrame([("a", None)], "k string, f string")
    new = spark.createDataFrame([("a", None), ("a", "x"), ("a", "x"), (None, None)], "k string, f string")
    assert {tuple(r) for r in storage.append_idempotent(new, old, ["k", "f"]).collect()} == {("a", "x"), (None, None)}


def test_one_bad_row_commits_nothing(spark):
    rows = spark.createDataFrame([("r", i, ["x"] if i == 2 else []) for i in range(1, 6)] + [("s", 1, [])], "release string, physical_row_number int, diagnostics array<string>")
    got = {r.release: r for r in release.release_outcome(rows, ["release"]).collect()}
    assert (got["r"].n_rows, got["r"].n_staged, got["r"].n_committed, got["r"].accepted) == (5, 1, 0, False)
    assert (got["s"].n_committed, got["s"].accepted) == (1, True)


def test_retention_keeps_a_hundred(spark):
    kept = release.retain(spark.range(150).select(F.lit("r").alias("release"), F.col("id").alias("row")), ["release"], ["row"])
    rows = kept.collect()
    assert len(rows) == 100 and {r.total for r in rows} == {150} and all(r.truncated for r in rows) and max(r.row for r in rows) == 99


def test_progress_ends_with_a_final_event(spark):
    counts = spark.createDataFrame([("a", 0), ("b", 250)], "release string, n_rows int")
    assert sorted(map(tuple, release.progress(counts, ["release"], 100).collect())) == [("a", 0, 0), ("b", 0, 100), ("b", 1, 200), ("b", 2, 250)]


def test_first_row_sets_the_facts(spark):
    rows = spark.createDataFrame([("p", 1, 10, "a"), ("p", 2, 11, "a"), ("p", 3, 11, "b"), ("q", 1, None, "a"), ("q", 2, None, "a")], "k string, n int, x int, y string")
    got = [(r.n, r.field) for r in validate.fact_conflicts(rows, ["k"], ["x", "y"], ["n"]).orderBy("n").collect()]
    assert got == [(2, "x"), (3, "x")]


def test_roll_split_never_fills(spark):
    rows = spark.createDataFrame([(1, 5, None, 2025), (2, 5, 7, None), (3, None, 8, 2025)], "id int, cur int, cert int, y int")
    got = sorted((r.id, r.family, r.v) for r in reshape.dual_roll_split(rows, {"v": "cur"}, {"v": "cert"}, "y").na.fill(-1).collect())
    assert got == [(1, "current", 5), (2, "current", 5), (3, "certified", 8), (3, "current", -1)]


def test_sensitive_columns_are_refused(spark):
    with pytest.raises(ValueError, match="owner"):
        reshape.non_sensitive(spark.range(1).withColumn("owner", F.lit("x")), ["id", "owner"], ["owner"])


def test_policy_is_default_deny(spark):
    values = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "source_field string, v string")
    policy = spark.createDataFrame([("a", True, "me", "2024", "R"), ("b", True, " ", "2024", "R")], "source_field string, publication_allowed boolean, approved_by string, approved_at string, review_reference string")
    assert [r.source_field for r in publish.publishable_fields(values, policy).collect()] == ["a"]


def test_unknown_marker_hides(spark):
    rows = spark.createDataFrame([(True, "x"), (False, "y"), (None, "z")], "m boolean, name string")
    assert [r.name for r in publish.suppress_protected(rows, F.col("m"), ["name"]).collect()] == [None, "y", None]


def test_promotion_keeps_one_current(spark):
    builds = spark.createDataFrame([("p", 1, "built"), ("p", 2, "built"), ("p", 3, "failed"), ("q", 1, "failed")], "product string, n int, state string")
    got = {(r["product"], r.n): r.state for r in publish.promote(builds, ["product"], [F.desc("n")]).collect()}
    assert got == {("p", 1): "superseded", ("p", 2): "current", ("p", 3): "failed", ("q", 1): "failed"}


def test_diverged_stays_diverged(spark):
    refs = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a")], "part string, sha string")
    new = spark.createDataFrame([("p", "a"), ("q", "a"), ("q", "b"), ("r", "a")], "part string, sha string")
    got = sorted((r.part, r.sha, r.classification) for r in match.classify_artifacts(new, refs, ["part"], "sha").collect())
    assert got == [("p", "a", "DIVERGED"), ("q", "a", "IDENTICAL"), ("q", "b", "DIVERGED"), ("r", "a", "NEW")]


def test_inventory_of_files(spark, tmp_path):
    for name, data in (("a", b"x"), ("b", b"x"), ("c", b"y")):
        (tmp_path / name).write_bytes(data)
    assert sorted(r.n for r in storage.content_inventory(spark, f"file://{tmp_path}").collect()) == [1, 2]


def test_export_and_manifest(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("k"), F.when(F.col("id") > 3, "x").alias("s"))
    sums = lambda m: {r.k: (r.n, r.c) for r in m.groupBy("k").agg(F.sum("n_rows").alias("n"), F.sum("checksum").alias("c")).collect()}
    made = [storage.bulk_export(d, f"file://{tmp_path}/{name}", ["k"], rows_per_file=n) for d, name, n in ((df, "a", 100), (df.repartition(5), "b", 10_000))]
    assert sums(made[0]) == sums(made[1]) and {k: n for k, (n, _) in sums(made[0]).items()} == {0: 500, 1: 500}
    rows = made[0].collect()
    assert max(r.n_rows for r in rows) <= 100 and all(len(r.sha256) == 64 and r.length > 0 for r in rows)
    kept = spark.createDataFrame(rows, made[0].schema)
    again = lambda: sorted(r.code for r in storage.manifest_faults(kept, storage.manifest(spark, f"file://{tmp_path}/a", df.schema, ["k"])).collect())
    assert again() == []
    files_ = sorted((tmp_path / "a").rglob("*.parquet"))
    files_[0].unlink()
    for f in files_[1:2]:
        f.write_bytes(files_[2].read_bytes())
        f.with_name("." + f.name + ".crc").unlink(missing_ok=True)
    spark.catalog.refreshByPath(f"file://{tmp_path}/a")
    assert again() == ["bytes_differ", "missing_file"]


def test_append_again_adds_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, None)], "k long, f string")
    for part in (rows.where("k = 2"), rows, rows):
        storage.append_records(part, path, ["k", "f"])
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == [(1, None), (2, "a"), (None, None)]
