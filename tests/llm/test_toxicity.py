"""Held-out accuracy, unseen misspellings and odd inputs."""

import numpy as np
import pyarrow as pa

from parcelwright.llm import toxicity


def invented(rng, n):
    return ["".join(rng.choice(list("aeioulmnrst"), 6)) for _ in range(n)]


def test_misspellings_share_subwords():
    rng = np.random.default_rng(2)
    vocab, bad = invented(rng, 400), ["wretched", "horrible", "dreadful"]
    texts, y = [], []
    for i in range(600):
        words = list(rng.choice(vocab, 40))
        if i % 3 == 0:
            for _ in range(3):
                words[int(rng.integers(40))] = bad[int(rng.integers(3))]
        texts.append(" ".join(words))
        y.append(float(i % 3 == 0))
    model = toxicity.train(pa.array(texts), np.array(y))
    plain = " ".join(rng.choice(vocab, 40))
    p = model.probability(pa.array([plain, plain + " wretchedd horible dreadfull wretchhed", "", None]))
    assert p[0] < 0.3 < p[1] and p[2] == p[3]


def test_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels, max_labels=400)).join(labels, "doc_id").where("held_out").toPandas()
    one, zero = scored[scored.toxic == 1].score, scored[scored.toxic == 0].score
    assert np.mean([(a > zero).mean() for a in one]) > 0.85


def test_odd_inputs(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (2, "")], "doc_id long, text string")
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len(got) == 4 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def plain_training(texts, y, epochs, rate=2.0, decay=1e-4, seed=7):
    """The same model by loops over documents, words and subwords: probabilities of the texts."""
    def buckets(word):
        marked = b"<" + word + b">"
        parts = [marked] + [marked[i : i + n] for n in toxicity.GRAMS for i in range(len(marked) - n + 1) if len(marked) > n]
        return [int(toxicity.tb.span_hashes(np.frombuffer(p, np.uint8), np.array([0]), np.array([len(p)]))[0] % np.uint64(toxicity.BUCKETS)) for p in parts]

    words = [[w.encode() for w in t.lower().split()] for t in texts]
    of = {w: buckets(w) for ws in words for w in ws}
    used = sorted({b for bs in of.values() for b in bs})
    at = {b: i for i, b in enumerate(used)}
    rng = np.random.default_rng(seed)
    e, c = rng.normal(0, 1 / toxicity.DIM, (len(used), toxicity.DIM)), rng.normal(0, 1, toxicity.DIM)
    prior = (sum(y) + 1) / (len(y) + 2)
    bias = float(np.log(prior / (1 - prior)))
    ge, gc, gb = np.full_like(e, 1e-10), np.full(toxicity.DIM, 1e-10), 1e-10
    vector = lambda w: np.mean([e[at[b]] for b in of[w]], axis=0)
    chance = lambda ws: 1 / (1 + np.exp(-(np.mean([vector(w) for w in ws], axis=0) @ c + bias)))
    for _ in range(epochs):
        de, dc, db = decay * e / len(y), np.zeros(toxicity.DIM), 0.0
        for ws, label in zip(words, y):
            d = (chance(ws) - label) / len(y)
            db += d
            for w in ws:
                dc += d / len(ws) * vector(w)
                for b in of[w]:
                    de[at[b]] += d / len(ws) / len(of[w]) * c
        ge, gc, gb = ge + de**2, gc + dc**2, gb + db**2
        e, c, bias = e - rate * de / np.sqrt(ge), c - rate * dc / np.sqrt(gc), bias - rate * db / np.sqrt(gb)
    return [chance(ws) for ws in words]


def test_training_against_loops():
    texts = ["you are kind", "you are awful awful", "kind words here", "awful words", "so awfull"]
    y = np.array([0.0, 1.0, 0.0, 1.0, 1.0])
    model = toxicity.train(pa.array(texts), y, epochs=4)
    assert np.allclose(model.probability(pa.array(texts)), plain_training(texts, y, 4), atol=1e-9)


def test_sample_is_bounded_and_repeats_count_once(spark):
    """One doc_id in very many rows is one sample; a smaller bound on words halves the sample; a very long text is read whole."""
    rows = [(i, f"word{i} is {'vile' if i % 2 else 'fine'}") for i in range(40)] + [(1, "word1 is vile")] * 500
    docs = spark.createDataFrame(rows + [(41, "fine " * 200_000 + "vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)], "doc_id long, toxic int")
    once = spark.createDataFrame(list(dict.fromkeys(rows)) + [(41, "fine " * 200_000 + "vile")], "doc_id long, text string")
    a, b = toxicity.fit(docs, labels), toxicity.fit(once, labels)
    assert np.allclose(a.logits, b.logits) and abs(a.bias - b.bias) < 1e-12
    assert (toxicity.fit(docs, labels, max_entries=400).logits != 0).sum() < (a.logits != 0).sum()


def test_ties_in_the_sample(spark, monkeypatch):
    """Documents whose hashes are equal are chosen by doc_id, so reruns and other partitions choose alike."""
    rows = [(i, f"w{i} {'vile' if i % 2 else 'fine'}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity.F, "xxhash64", lambda *c: toxicity.F.lit(5).cast("long"))
    a = toxicity.fit(docs, labels, max_labels=10)
    b = toxicity.fit(docs.repartition(5), labels.repartition(3), max_labels=10)
    assert (a.logits == b.logits).all() and a.bias == b.bias and (a.logits != 0).any()
