"""Ranked search against brute force, bounds that really skip, and odd inputs."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from parcelwright.llm import search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, n_words = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item_id, text in items:
        scores = []
        for d, b, n in bags:
            m = 25 + 75 * n * n_docs // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms(text) if b[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search.search(d, i, **more).collect()), key=str)


@pytest.mark.parametrize(("block", "shard_docs"), [(1, 7), (4, 50), (32, 4096)])
def test_equals_brute_force(spark, block, shard_docs):
    rng = np.random.default_rng(block)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "中文", "0"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    pick = lambda n: " ".join(rng.choice(vocabulary, n, p=weights / weights.sum()))
    docs = [(int(i), pick(rng.integers(1, 60)).upper() if i % 3 else pick(rng.integers(1, 400))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # ties
    items = [(i, pick(rng.integers(1, 25))) for i in range(25)]
    assert found(spark, docs, items, block=block, shard_docs=shard_docs) == brute(docs, items)


def test_odd_rows(spark):
    long = "rare " + "filler " * 200_000
    docs = [(1, None), (2, ""), (3, "... --"), (4, "a b"), (4, "a b"), (None, "a b"), (5, long), (6, "A a a c"), (7, "x" * 300_000), (8, "filler"), (9, "zz"), (10, "yy")]
    items = [(1, "a"), (2, None), (3, "!!"), (4, "unknown words"), (5, "rare filler a a b"), (6, "x" * 300_000), (6, "c")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []
    wide = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, score long, `rank` int")
    named = spark.createDataFrame([("i", "b", 0)], "item_id string, text string, doc_id long")
    assert search.search(wide, named).count() == 1  # other columns don't matter
    assert found(spark, [(1, "a")], [(1, "a")]) == brute([(1, "a")], [(1, "a")])


def test_many_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(search, "ITEMS", 3)
    docs = [(i, f"common w{i % 5} v{i % 7} u{i}") for i in range(60)]
    items = [(i, f"w{i % 5} v{i % 3} common") for i in range(8)]
    assert found(spark, docs, items, k=4) == brute(docs, items, 4)


def test_summaries_bound_every_document():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 12, 300)
    term = np.concatenate([np.sort(rng.choice(40, s, replace=False)) for s in sizes])
    shard = search.Shard(sizes, term, rng.integers(1, 1000, len(term)), 40)
    for t in range(40):
        blocks, summary = shard.blocks(t, 8)
        assert sorted(np.concatenate(blocks)) == sorted(shard.lists[t]) and max(map(len, blocks)) <= 8
        for b, s in zip(blocks, summary):
            weights = rng.integers(0, 9, 40)
            assert (shard.scores(b, weights) <= s @ weights).all()


def test_blocks_group_like_documents_and_are_skipped():
    rng = np.random.default_rng(5)
    topic = np.arange(2000) % 20
    term = np.stack([np.zeros(2000, int), *(1 + topic * 5 + i for i in range(5))], 1).ravel()  # one common term, five of the topic
    impact = rng.integers(900, 1000, len(term))
    shard = search.Shard(np.full(2000, 6), term, impact, 101)
    blocks, _ = shard.blocks(0, 32)
    alike = np.mean([np.bincount(topic[b]).max() / len(b) for b in blocks])
    assert alike > 0.5  # 0.05 and a little if dealt at random
    best, stats = [search.Best(10)], {}
    items = [(np.array([0, 1, 2, 3]), np.array([1, 1, 1, 1]))]
    search.search_shard(shard, list(range(2000)), items, best, np.full(101, 10), 32, stats)
    dense = np.zeros(101, np.int64)
    dense[:4] = 10
    scores = shard.scores(np.arange(2000), dense)
    assert [(-s, d) for s, _, d in best[0].rows] == sorted(((int(s), d) for d, s in enumerate(scores)), key=lambda x: (-x[0], x[1]))[:10]
    assert stats["scored"] <= 200  # of 2 000 documents that hold a term


@settings(max_examples=60, deadline=None)
@given(data=st.data())
def test_search_shard_is_exact(data):
    n_terms = data.draw(st.integers(1, 8))
    docs = data.draw(st.lists(st.dictionaries(st.integers(0, n_terms - 1), st.integers(1, 5), min_size=1), min_size=1, max_size=40))
    query = data.draw(st.dictionaries(st.integers(0, n_terms - 1), st.integers(1, 3), min_size=1))
    weights = np.array(data.draw(st.lists(st.integers(0, 4), min_size=n_terms, max_size=n_terms)))
    ordered = [sorted(d.items()) for d in docs]
    shard = search.Shard(np.array([len(d) for d in docs]), np.array([t for d in ordered for t, _ in d]), np.array([v for d in ordered for _, v in d]), n_terms)
    best = [search.Best(3)]
    q = sorted(query.items())
    search.search_shard(shard, list(range(len(docs))), [(np.array([t for t, _ in q]), np.array([r for _, r in q]))], best, weights, 2)
    scores = [(-sum(weights[t] * r * d.get(t, 0) for t, r in q), i) for i, d in enumerate(docs)]
    assert [(s, d) for s, _, d in best[0].rows] == sorted(x for x in scores if x[0] < 0)[:3]
