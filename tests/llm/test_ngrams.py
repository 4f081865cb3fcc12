"""The language model against dictionaries, and Elias-Fano round trips."""

import math
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from parcelwright.llm import ngrams

BLANK = r"[^\x20\x09-\x0D]+"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1 << 56), (5, 3), (1000, 1 << 20), (1000, 1 << 56), (3000, 10)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top, n).astype(np.uint64))
    sequence = ngrams.EliasFano(ngrams.EliasFano.encode(values))
    assert (sequence.decode() == values).all()
    at = np.arange(n)[::-3]
    assert (sequence.access(at) == values[at]).all()


@pytest.mark.parametrize("n", [0, 1, 40, 5000])
def test_level_in_a_memory_map(n, tmp_path):
    """Successor search in a mapped file finds all children and none that aren't there, in dense contexts too."""
    rng = np.random.default_rng(n)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 40, n), rng.integers(0, 1 << 23, n)]).astype(np.uint64))
    counts = rng.integers(1, 900, len(keys))
    (tmp_path / "level").write_bytes(ngrams.Level.image(keys, counts, 22, True))
    level = ngrams.Level(np.memmap(tmp_path / "level", np.uint8, "r"))
    assert (level.find(keys) == np.arange(len(keys))).all()
    assert (ngrams.restored(level.codes) == counts).all() and (level.counts == counts).all()
    others = np.setdiff1d(np.concatenate([rng.integers(0, 1 << 40, 2000).astype(np.uint64), keys + np.uint64(1)]), keys)
    assert (level.find(others[others < 1 << 40]) == -1).all()
    highs = np.arange(0, 1 << 18, 997)
    assert (level.keys.before(highs) == np.searchsorted(keys >> np.uint64(22), highs.astype(np.uint64))).all()


def brute(rows, order, m):
    docs = [re.findall(BLANK, (t or "").translate(AZ)) + [None] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    grams = [Counter() for _ in range(order + 1)]
    for words, h in zip(docs, held):
        padded = ["<s>"] * (order - 1) + words
        for i in range(len(words) if not h else 0):
            for k in range(1, order + 1):
                grams[k][tuple(padded[i + order - k : i + order])] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    starts = grams[1][(None,)]

    def p(gram):
        if len(gram) == 1:
            return (grams[1][gram] + 0.1) / (n + 0.1 * (v + 1))
        context = gram[:-1]
        seen = starts if context == ("<s>",) else 0 if context.count("<s>") > 1 else grams[len(context)][context]
        return (grams[len(gram)][gram] + m[len(gram)] * p(gram[1:])) / (seen + m[len(gram)]) if seen else p(gram[1:])

    for (d, _), words, h in zip(rows, docs, held):
        padded = ["<s>"] * (order - 1) + words
        score = sum(math.log10(p(tuple(padded[i : i + order]))) for i in range(len(words)))
        yield d, h, len(words), sum(grams[1][(w,)] > 0 for w in words), n, sum(math.log10(p((w,))) for w in words), score


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores(spark, sf_dir, order):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(-1, None), (-2, ""), (-3, "A a\tÉ é"), (-3, "A a\tÉ é"), (None, "the of"), (-4, "the " * 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    m = {2: 30.0, 3: 20.0, 4: 10.0}
    got = sorted(map(tuple, ngrams.lm_scores(frame, order=order, block_bytes=60_000, shard_keys=20_000, concentration=m).collect()), key=lambda r: (r[0] is None, r[0], r[2]))
    want = sorted(brute(rows, order, m), key=lambda r: (r[0] is None, r[0], r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert abs(a[5] - b[5]) < 1e-6
        assert abs(a[6] - b[6]) <= 6e-4 * a[2]


def test_empty(spark):
    assert ngrams.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = ngrams.lm_scores(spark.createDataFrame([(0, None), (1, None)], "doc_id long, text string")).collect()
    assert [r.n_tokens for r in one] == [1, 1]


def _words(n, seed):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 300) % 5000)) for i in range(n)]


def test_kept_model_scores_other_texts(spark, tmp_path):
    """A saved and loaded model gives texts that it hasn't seen the scores of a dictionary of the same counts."""
    docs = spark.createDataFrame(_words(60, 1), "doc_id long, text string")
    model, _, _ = ngrams.train(docs, block_bytes=20_000, shard_keys=3_000)
    model.save(str(tmp_path / "model"))
    kept = ngrams.Model.load(spark, str(tmp_path / "model"))
    assert kept.shard_bits > 0 and (kept.tokens, kept.types) == (model.tokens, model.types)
    again = [(r.doc_id, r.text) for r in docs.collect()]
    new = [(1000, "w1 w2 never seen before"), (1010, None), (None, "w1 w1 w1")] + again
    got = {r.doc_id: r for r in ngrams.score(spark.createDataFrame(new, "doc_id long, text string"), kept, block_bytes=20_000).collect()}
    # texts to be scored must not train: hold them out of the brute force by ids that fall in fold 0
    held = [i for i in range(10_000, 10_200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    want = {r[0]: r for r in brute(again + [(h, t) for h, (_, t) in zip(held, new)], 3, ngrams.CONCENTRATION)}
    for h, (d, _) in zip(held, new):
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == want[h][2:5]
        assert abs(got[d].score - want[h][6]) < 6e-4 * got[d].n_tokens and abs(got[d].base_score - want[h][5]) < 1e-6
    assert all(abs(got[d].score - want[d][6]) < 6e-4 * got[d].n_tokens for d, _ in again)


def test_messages_follow_ngrams(spark):
    """Four times the texts, four times the rows exchanged, and never more than one for MESSAGE_KEYS n-grams and one a block and order."""
    told = []
    for n in (40, 160):
        docs = spark.createDataFrame(_words(n, 2), "doc_id long, text string").coalesce(1)
        total = sum(len(t) for _, t in _words(n, 2))
        bits = ngrams.shard_bits_for(total, 10, 8_000)
        asked = ngrams.requests(ngrams.packed_blocks(docs, 8_000), 3, bits).cache()
        keys = sum(ngrams.EliasFano(bytes(r.keys)).n for r in asked.select("keys").collect())
        told.append((asked.count(), keys))
    (few, few_keys), (many, many_keys) = told
    assert many / few < 1.1 * many_keys / few_keys
    assert all(rows <= 2 * keys / ngrams.MESSAGE_KEYS for rows, keys in told)


def test_counts_beyond_32_bits(tmp_path):
    keys = np.array([3, 5, 1 << 30], np.uint64)
    counts = np.array([1, 5_000_000_000, 7 << 40])
    level = ngrams.Level(ngrams.Level.image(keys, counts, 20, True))
    _, exact = level.answers(keys)
    assert ngrams._inflated(exact, "<u8").tolist() == counts.tolist()


def test_many_children_of_one_word(spark):
    """200 000 children of one context: unseen ones stay unseen, and counts of seen ones are their own."""
    n = 200_000
    text = " ".join(f"the w{i}" for i in range(n))
    rows = [(1, text), (2, " ".join(f"the w{i}" for i in range(0, n, 7)))]
    held = [i for i in range(10_000, 10_400) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows += [(held[0], " ".join(f"the x{i}" for i in range(5000))), (held[1], " ".join(f"the w{i}" for i in range(3, n, 11)))]
    assert all(zlib.crc32(str(i).encode()) % 10 for i in (1, 2))
    got = {r.doc_id: r for r in ngrams.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    for w in brute(rows, 3, ngrams.CONCENTRATION):
        assert abs(got[w[0]].score - w[6]) <= 6e-4 * w[2] and abs(got[w[0]].base_score - w[5]) <= 1e-9 * w[2] * 10


def test_training_leaves_no_shuffle_files(spark, monkeypatch):
    """What blocks ask of shards is gone when the levels are written: scoring's own shuffle doesn't come on top."""
    local = [Path(str(p)) for p in spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f: f.stat().st_size for p in local for f in p.rglob("shuffle_*.data")}
    before, conf, written, asked = files(), spark.conf.get(ngrams.store.DROP_SHUFFLES), ngrams.store.written, {}

    def watched(df, name, **how):  # files may also go early by chance, so what is asked for counts too
        asked[name] = how
        return written(df, name, **how)

    monkeypatch.setattr(ngrams.store, "written", watched)
    model, blocks, replies = ngrams.train(spark.createDataFrame(_words(400, 3), "doc_id long, text string"), block_bytes=60_000, shard_keys=20_000)
    for _ in range(40):
        left = sum(n for f, n in files().items() if f not in before)
        if left < 20_000:
            break
        time.sleep(0.25)
    assert left < 20_000
    assert asked["levels"] == {"drop_shuffles": True}
    assert spark.conf.get(ngrams.store.DROP_SHUFFLES) == conf
    assert ngrams._scores(blocks, replies, model, ngrams.CONCENTRATION).count() == 400
