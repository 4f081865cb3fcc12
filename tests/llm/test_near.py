"""Near-duplicates against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwright.llm import near

BLANK = r"[^\x20\x09-\x0D]+"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(BLANK, (text or "").translate(AZ))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if find(i) != find(j) and 100 * both >= 85 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def test_components(spark, sf_dir):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    base = [word() for _ in range(150)]
    for i in range(120):  # one large group, of chains around the threshold
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(150)] = word()
        rows.append((5000 + i, " ".join(copy)))
    boiler = " ".join(word() for _ in range(40))
    rows += [(6000 + i, boiler + " " + " ".join(word() for _ in range(60))) for i in range(60)]
    rows += [(-1, None), (-2, ""), (-3, "one two"), (-4, "One\nTWO"), (-5, "one two three"), (-6, rows[0][1]), (-6, rows[0][1]), (-7, " \n"), (-8, "w " * 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set_key", F.lit(1))
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(frame).collect())
    assert got == brute(rows)


def test_empty(spark):
    assert near.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def dense_components(rows):
    """brute for groups of thousands: shared shingles counted by one product of matrices."""
    sets = [shingles(t) for _, t in rows]
    held = Counter(x for s in sets for x in s)
    number = {x: k for k, x in enumerate(x for x, k in held.items() if k > 1)}
    has = np.zeros((len(sets), len(number)), np.float32)
    for i, s in enumerate(sets):
        has[i, [number[x] for x in s if x in number]] = 1
    both, size = (has @ has.T).astype(int), np.array([len(s) for s in sets])
    link = 100 * both >= 85 * (size[:, None] + size - both)
    least = {}
    for i in range(len(rows)):
        todo = [i] if i not in least else []
        group = set(todo)
        while todo:
            more = set(np.flatnonzero(link[todo].any(axis=0)).tolist()) - group
            group |= more
            todo = list(more)
        least |= {j: min(rows[k][0] for k in group) for j in group}
    return {d: least[i] for i, (d, _) in enumerate(rows)}


@pytest.mark.parametrize("tile_sets", [near.TILE_SETS, 300])
def test_hub(spark, monkeypatch, tile_sets):
    """Thousands of copies that are linked with their base only, which is not the least set_key."""
    monkeypatch.setattr(near, "TILE_SETS", tile_sets, raising=False)
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = [word() for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 3000):
        copy = list(base)
        for at in rng.sample(range(5, 145), 2):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = dense_components(rows)
    assert got == want and len(set(want.values())) < 3


def test_common_counts():
    rng = np.random.default_rng(4)
    sets = [set(rng.integers(0, 60, 20).tolist()) | set(rng.integers(100, 4000, 40).tolist()) for _ in range(200)]
    row = np.repeat(np.arange(200), [len(s) for s in sets])
    shingle = np.array([x for s in sets for x in s], np.uint64)
    both = near.common_counts(row, shingle, 200)
    assert all(both[i, j] == len(sets[i] & sets[j]) for i in range(200) for j in range(200) if i != j)


def test_twins_behind_one_boilerplate(spark):
    """Every text shares most of its words with all others, below the threshold; each has one twin above it: no twin is lost."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    common = [word() for _ in range(400)]
    rows = []
    for k in range(300):
        own = [word() for _ in range(50)]
        rows.append((2 * k, " ".join(common + own)))
        rows.append((2 * k + 1, " ".join(common + own[:-25] + [word() for _ in range(25)])))
    got = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for d, t in rows}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    assert all(linked(2 * k, 2 * k + 1) for k in range(300)) and not linked(0, 2)
    assert got == {d: d - d % 2 for d, _ in rows}


def test_keep_one_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    for name in ("_near_doc", "_near_text", "_row", "th", "set_key", "a.b"):
        docs = docs.withColumn(name, F.lit("mine"))
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
