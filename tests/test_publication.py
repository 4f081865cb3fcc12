"""Publication by a pointer, intake against a ledger, bounded candidates, progress, fingerprints, and look-up layout."""

import pytest
from pyspark.sql import functions as F

from parcelwright.operators import match, publish, release, versions
from parcelwright.streaming.intake import Intake

BUILD = "publication long, product string, county string, run long, state string, published_at string"
RECORD = "product string, county string, run long, account string"
SEEN = "product string, county string, account string"


def builds(spark, *rows):
    return spark.createDataFrame(rows, BUILD).withColumn("published_at", F.col("published_at").cast("timestamp"))


def records(spark, *rows):
    return spark.createDataFrame(rows, RECORD)


def runs(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "run long")


def seen(p, version=None):
    return sorted((r.product, r.county, r.account) for r in p.read(SEEN, version).collect())


def states(p):
    return sorted((r.publication, r.state, r.superseded_by) for r in p.table().collect())


def test_a_promotion_that_fails_before_its_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    p = versions.Publications(spark, f"file://{tmp_path}/p")
    assert p.version() == 0 and seen(p) == [] and states(p) == []
    p.promote(builds(spark, (1, "latest", "a", 10, "built", "2025-01-01"), (2, "latest", "b", 11, "built", "2025-01-01")), records(spark, ("latest", "a", 10, "x"), ("latest", "b", 11, "y"), ("latest", "b", 99, "other run")), runs(spark, 10, 11))
    first = [("latest", "a", "x"), ("latest", "b", "y")]
    assert seen(p) == first
    second = builds(spark, (3, "latest", "a", 12, "built", "2025-02-01")), records(spark, ("latest", "a", 12, "z")), runs(spark, 12)
    with monkeypatch.context() as m:
        m.setattr(versions.Publications, "_point", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            p.promote(*second)
    assert p.version() == 1 and seen(p) == first  # the second version's records lie there, unseen
    p.promote(*second)
    assert seen(p) == [("latest", "a", "z"), ("latest", "b", "y")] and seen(p, 1) == first
    assert states(p) == [(1, "superseded", 3), (2, "current", None), (3, "current", None)]


def test_failed_and_blocked_builds_leave_what_was_current(spark, tmp_path):
    p = versions.Publications(spark, f"file://{tmp_path}/p")
    p.promote(builds(spark, (1, "latest", "a", 10, "built", "2025-01-01")), records(spark, ("latest", "a", 10, "x")), runs(spark, 10))
    p.promote(builds(spark, (2, "latest", "a", 11, "failed", "2025-02-01"), (3, "latest", "a", 12, "built", "2025-03-01")), records(spark, ("latest", "a", 11, "bad"), ("latest", "a", 12, "bad")), runs(spark, 10, 11))
    assert seen(p) == [("latest", "a", "x")] and states(p) == [(1, "current", None), (2, "failed", None), (3, "failed", None)]
    p.promote(builds(spark, (4, "latest", "a", 13, "built", "2025-04-01"), (5, "latest", "a", 14, "built", "2025-05-01")), records(spark, ("latest", "a", 13, "m"), ("latest", "a", 14, "n")), runs(spark, 13, 14))
    assert seen(p) == [("latest", "a", "n")] and states(p) == [(1, "superseded", 4), (2, "failed", None), (3, "failed", None), (4, "superseded", 5), (5, "current", None)]


def test_two_promotions_at_once(spark, tmp_path):
    p = versions.Publications(spark, f"file://{tmp_path}/p")
    one = builds(spark, (1, "latest", "a", 10, "built", "2025-01-01")), records(spark, ("latest", "a", 10, "x")), runs(spark, 10)
    p.promote(*one)
    table = p.table()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        p._point(table, 1)


def deliver(folder, delivery, **files):
    for part, text in files.items():
        d = folder / f"delivery={delivery}" / f"p={part[1:]}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{part}.txt").write_text(text)


def test_intake_ledger_and_replay(spark, tmp_path):
    taker = Intake(spark, f"file://{tmp_path}/out", f"file://{tmp_path}/ledger", r"/p=([0-9]+)/")
    source = f"file://{tmp_path}/in/delivery=*/p=*"
    deliver(tmp_path / "in", 1, a1="r1\nr2\n", a2="s1\n")
    taker.run(source, f"file://{tmp_path}/state")
    deliver(tmp_path / "in", 2, b1="r1\nr2\n", b2="changed\n", b3="new\n")
    taker.run(source, f"file://{tmp_path}/state")
    taker.run(source, f"file://{tmp_path}/state")
    state = lambda: sorted((r.member.rsplit("/", 1)[1], r.partition_key, r.classification, r.batch) for r in taker.ledger().collect())
    taken = lambda: sorted((r.member.rsplit("/", 1)[1], r.value) for r in taker.taken().collect())
    want = [("a1.txt", "1", "NEW", 0), ("a2.txt", "2", "NEW", 0), ("b1.txt", "1", "IDENTICAL", 1), ("b2.txt", "2", "DIVERGED", 1), ("b3.txt", "3", "NEW", 1)]
    rows = [("a1.txt", "r1"), ("a1.txt", "r2"), ("a2.txt", "s1"), ("b2.txt", "changed"), ("b3.txt", "new")]
    assert state() == want and taken() == rows
    names = [f"file://{tmp_path}/in/delivery=2/p={k}/b{k}.txt" for k in (1, 2, 3)]
    batch = spark.createDataFrame([(names[0], "r1"), (names[0], "r2"), (names[1], "changed"), (names[2], "new")], "member string, value string")
    taker.take(batch, 1)  # a batch that is repeated after a failure
    assert state() == want and taken() == rows


def test_files_of_one_batch_meet_in_the_order_of_their_names(spark, tmp_path):
    taker = Intake(spark, f"file://{tmp_path}/out", f"file://{tmp_path}/ledger", r"/p=([0-9]+)/")
    for name, text in (("a", "x\n"), ("b", "y\n"), ("c", "x\n")):
        d = tmp_path / "in" / "p=1"
        d.mkdir(parents=True, exist_ok=True)
        (d / name).write_text(text)
    taker.run(f"file://{tmp_path}/in/p=*", f"file://{tmp_path}/state")
    assert sorted((r.member[-1], r.classification) for r in taker.ledger().collect()) == [("a", "NEW"), ("b", "DIVERGED"), ("c", "IDENTICAL")]


def test_bounded_candidates_stay_linear(spark):
    n = 2000
    a = spark.range(n).select(F.col("id").alias("a"), F.lit(1).alias("county"), F.when(F.col("id") % 2 == 0, "PO Box 1").otherwise(F.concat(F.lit("No "), "id")).alias("address"))
    p = spark.range(n).select(F.col("id").alias("p"), F.lit(1).alias("county"), F.when(F.col("id") % 2 == 0, "p.o. box 1").otherwise(F.concat(F.lit("NO. "), "id")).alias("address"))
    p = p.withColumn("address", F.when(F.col("p") % 2 == 0, "po box 1").otherwise(F.col("address")))
    exact = a.select("a").limit(0)
    pairs, classes = match.bounded_candidates(a, p, exact, "a", "p", "county", "address")
    assert pairs.count() == n // 2 and classes.count() == n  # not a million
    assert {(r.n_accounts, r.n_properties) for r in classes.collect()} == {(n // 2, n // 2)}
    whole, none = match.bounded_candidates(a, p, exact, "a", "p", "county", "address", most_pairs=n * n)
    assert none.count() == 0 and whole.count() == match.candidate_match(a, p, exact, "a", "county", "address").count()


def test_staged_progress(spark):
    rows = [("a", i, 2, i == 7) for i in range(1, 13)] + [("b", i, 1, False) for i in range(1, 11)] + [("c", 1, 3, True)]
    df = spark.createDataFrame(rows, "release string, physical_row_number long, n_records long, rejected boolean")
    got = sorted(tuple(r) for r in release.staged_progress(df, ["release"], 5).collect())
    assert got == [("a", 0, 5, 10, False), ("a", 1, 10, 12, False), ("a", 2, 12, 12, True), ("b", 0, 5, 5, False), ("b", 1, 10, 10, False), ("b", 2, 10, 10, True), ("c", 0, 1, 0, True)]


def test_fingerprints_merge_and_know_every_row(spark):
    rows = [(i % 3, i % 2, i, None if i % 5 else "x") for i in range(60)]
    df = spark.createDataFrame(rows, "county int, year int, k long, v string")
    fine = release.fingerprinted(df, ["county", "year"], ["k", "v"])
    whole = release.fingerprinted(df, [], ["k", "v"]).first()
    assert release.merged_fingerprints(fine, []).first() == whole and whole.n_rows == 60
    assert release.fingerprinted(df.repartition(7), [], ["k", "v"]).first() == whole
    for changed in (df.where("k <> 7"), df.unionByName(df.where("k = 7")), df.withColumn("v", F.when(F.col("k") == 7, "").otherwise(F.col("v")))):
        assert release.fingerprinted(changed, [], ["k", "v"]).first().fingerprint != whole.fingerprint
    top = release.keyed_evidence(df, ["county", "year"], ["v"], ["k", "v"]).where("county is null and year is null").first()
    assert (top.n_rows, top.fingerprint) == (60, whole.fingerprint)


def test_lookup_layout(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(20_000).select((F.col("id") % 3).cast("int").alias("county"), F.lpad(F.col("id").cast("string"), 17, "0").alias("account_id"), F.col("id").alias("value"))
    publish.write_lookup(df, f"file://{tmp_path}/g", rows_per_file=2_000, rows_per_group=500)
    files = sorted((tmp_path / "g" / "county=1").rglob("*.parquet"))
    assert len(files) > 1
    spans = []
    for f in files:
        m = pq.ParquetFile(f).metadata
        at = m.schema.names.index("account_id")
        spans += [(m.row_group(i).column(at).statistics.min, m.row_group(i).column(at).statistics.max) for i in range(m.num_row_groups)]
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # row groups don't overlap, so statistics find one
    gold = spark.read.schema(df.schema).parquet(f"file://{tmp_path}/g")
    one = publish.account_lookup(gold, 1, F.lit("1".rjust(17, "0")))
    plan = one._jdf.queryExecution().toString()
    assert [r.value for r in one.collect()] == [1] and "PartitionFilters: [isnotnull(county" in plan and "EqualTo(account_id" in plan
