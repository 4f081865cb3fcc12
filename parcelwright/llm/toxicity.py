"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from parcelwright.llm import textbatch as tb
from parcelwright.sources import workspace as store

#: Buckets of subword hashes, length of vectors, and the lengths of subwords in bytes (ends marked).
BUCKETS = 1 << 18
DIM = 8
GRAMS = (3, 4, 5, 6)
#: What is fitted on at most: labelled documents of each class, chosen by a hash of doc_id, and their distinct buckets, summed over
#: documents. These bound the bytes that reach the driver: 8 a bucket of a document.
MAX_LABELS = 2_500
MAX_ENTRIES = 10_000_000
HELD_OUT = 2

_MARKED = np.frombuffer(b"<>", np.uint8)


def subwords(w: tb.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each subword of the words at `which`, and the n+1 offsets of words into them.

    A word <w> has itself and all its byte runs of GRAMS lengths, so misspellings share most runs.
    """
    lengths = w.ends[which] - w.starts[which]
    size = lengths + 2
    at = np.concatenate([[0], np.cumsum(size)])
    data = np.empty(at[-1], np.uint8)
    data[at[:-1]], data[at[1:] - 1] = _MARKED
    inner = np.repeat(w.starts[which] - at[:-1] - 1, lengths) + np.delete(np.arange(at[-1]), np.concatenate([at[:-1], at[1:] - 1]))
    data[np.delete(np.arange(at[-1]), np.concatenate([at[:-1], at[1:] - 1]))] = w.data[inner]
    owner = np.repeat(np.arange(len(which)), size)
    hashes, owners = [tb.span_hashes(data, at[:-1], at[1:])], [np.arange(len(which))]
    for n in GRAMS:
        start = np.flatnonzero(owner[: max(len(data) - n + 1, 0)] == owner[n - 1 :]) if len(data) >= n else np.zeros(0, np.int64)
        start = start[size[owner[start]] > n]
        hashes.append(tb.span_hashes(data, start, start + n))
        owners.append(owner[start])
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owners, kind="stable")
    return (hashes[order] % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(owners[order], np.arange(len(which) + 1))


def _means(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of each stretch of values; 0 for an empty stretch."""
    return tb.per_doc(values, first) / np.maximum(np.diff(first), 1)


@dataclass(frozen=True)
class Bag:
    """Per-bucket logits: the trained embeddings times the softmax weights' difference; and the bias."""

    logits: np.ndarray
    bias: float

    def probability(self, column: pa.Array) -> np.ndarray:
        w = tb.Words(column, tb.NOT_ALNUM, lower=True)
        _, which, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
        margin = np.full(w.n_docs, self.bias)
        if len(w):
            buckets, first = subwords(w, which)
            margin += _means(_means(self.logits[buckets], first)[back], w.first)
        return 1 / (1 + np.exp(-margin))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text as its buckets' weights: n+1 offsets of texts, buckets, weights.

    A word's vector is the mean of its subwords' vectors, a text's the mean of its words', both linear: a bucket weighs in a text
    what its subwords make up of their words, times what these make up of the text.
    """
    w = tb.Words(column, tb.NOT_ALNUM, lower=True)
    if not len(w):
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.int32), np.zeros(0)
    hashes, which, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
    pair, n_in = np.unique(w.doc * len(hashes) + back, return_counts=True)
    doc, word = np.divmod(pair, len(hashes))
    buckets, first = subwords(w, which)
    size = np.diff(first)[word]
    at = np.cumsum(size) - size
    spread = np.arange(size.sum()) + np.repeat(first[:-1][word] - at, size)
    key, back = np.unique(np.repeat(doc, size) * BUCKETS + buckets[spread], return_inverse=True)
    weight = np.bincount(back, np.repeat(n_in / w.counts[doc] / size, size))
    return np.searchsorted(key, np.arange(len(column) + 1) * BUCKETS), (key % BUCKETS).astype(np.int32), weight


def train(texts: pa.Array, y: np.ndarray, **how) -> Bag:
    """train_bag over texts at hand."""
    return train_bag(*features(texts), y, **how)


#: Entries that are summed at a time: what fits a processor's cache.
STRETCH = 1 << 17


def _tally(values: np.ndarray, n: int) -> np.ndarray:
    """How often each of 0 to n - 1 is among values, without a wide copy of them."""
    out = np.zeros(n, np.int64)
    for at in range(0, len(values), STRETCH):
        out += np.bincount(values[at : at + STRETCH], minlength=n)
    return out


def _stretches(at: np.ndarray) -> np.ndarray:
    """Cuts of rows (n+1 offsets) into stretches of about STRETCH entries."""
    cuts = np.searchsorted(at, np.arange(0, at[-1], STRETCH), "left")
    return np.unique(np.concatenate([[0], cuts, [len(at) - 1]]))


def _sums(values: np.ndarray, which: np.ndarray, weight: np.ndarray, at: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each row of n+1 offsets: the sum of values[which] times weight over its entries."""
    out = np.zeros(len(at) - 1)
    for lo, hi in zip(cuts, cuts[1:]):
        a, b = at[lo], at[hi]
        filled = np.flatnonzero(np.diff(at[lo : hi + 1])) + lo
        if len(filled):
            out[filled] = np.add.reduceat(values[which[a:b]] * weight[a:b], at[filled] - a)
    return out


def train_bag(first: np.ndarray, bucket: np.ndarray, weight: np.ndarray, y: np.ndarray, epochs: int = 120, rate: float = 2.0, decay: float = 1e-4, seed: int = 7) -> Bag:
    """Embeddings of subword buckets and softmax weights, by full-batch Adagrad on the log loss.

    Texts come as features gives them; weights may be of single precision. One class only, or no bucket, gives the prior. Beside
    the entries themselves a second copy in the order of buckets is held; sums go over stretches of both. bucket is overwritten.
    """
    prior = (y.sum() + 1) / (len(y) + 2)
    bias0 = float(np.log(prior / (1 - prior)))
    if not 0 < y.sum() < len(y) or not len(bucket):
        return Bag(np.zeros(BUCKETS), bias0)
    n = len(y)
    used = np.flatnonzero(_tally(bucket, BUCKETS))
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    local = bucket
    for at in range(0, len(local), STRETCH):
        local[at : at + STRETCH] = place[local[at : at + STRETCH]]
    order = np.argsort(local, kind="stable")
    weight_of = weight[order]
    doc_of = np.repeat(np.arange(n, dtype=np.int32), np.diff(first))[order]
    del order
    by_used = np.concatenate([[0], np.cumsum(_tally(local, len(used)))])
    stretches = [_stretches(at) for at in (first, by_used)]
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1 / DIM, (len(used), DIM))
    c = rng.normal(0, 1, DIM)
    bias = bias0
    ge, gc, gb = np.full_like(e, 1e-10), np.full(DIM, 1e-10), 1e-10

    for _ in range(epochs):
        # pooling is linear, so it runs over e @ c, a number for each bucket
        d = (1 / (1 + np.exp(-_sums(e @ c, local, weight, first, stretches[0]) - bias)) - y) / n
        to_used = _sums(d, doc_of, weight_of, by_used, stretches[1])
        grad_e, grad_c, grad_b = to_used[:, None] * c[None, :] + decay * e / n, e.T @ to_used, d.sum()
        ge += grad_e**2
        gc += grad_c**2
        gb += grad_b**2
        e -= rate * grad_e / np.sqrt(ge)
        c -= rate * grad_c / np.sqrt(gc)
        bias -= rate * grad_b / np.sqrt(gb)
    logits = np.zeros(BUCKETS)
    logits[used] = e @ c
    return Bag(logits, float(bias))


def in_fold(doc_id, n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def _sampled(chosen: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, y, n, buckets, weights): the features, packed, of one row of each chosen document: of those of a doc_id the one
    whose text has the least hash."""
    kind = dict(docs.dtypes)["doc_id"]
    hashed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    one = hashed.drop("text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("th").alias("th"))  # as few rows as chosen

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for whole in batches:
            for batch in tb.slices(whole):
                ids = batch.column("doc_id").to_pylist()
                fresh = [i for i, d in enumerate(ids) if d not in seen and not seen.add(d)]  # repeated rows of a document, once a task
                if not fresh:
                    continue
                batch = batch.take(pa.array(fresh))
                first, bucket, weight = features(batch.column("text"))
                packed = [pa.array([x[lo:hi].tobytes() for lo, hi in zip(first, first[1:])], pa.binary()) for x in (bucket.astype("<i4"), weight.astype("<f4"))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(np.diff(first)), *packed], names=["doc_id", "y", "n", "buckets", "weights"])

    met = hashed.join(F.broadcast(one), ["doc_id", "th"]).select("doc_id", "y", "text")
    found = met.mapInArrow(rows, f"doc_id {kind}, y int, n long, buckets binary, weights binary")
    # copies of a document from several tasks: numbers meet, the features stay where they are
    numbered = store.written(found.withColumn("_row", F.monotonically_increasing_id()), "sampled")
    least = numbered.groupBy("doc_id").agg(F.min("_row").alias("_row")).select("_row")  # as few rows as chosen
    return numbered.join(F.broadcast(least), "_row", "left_semi").drop("_row")


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, label: str = "toxic", max_entries: int = MAX_ENTRIES) -> Bag:
    """A model from at most max_labels documents of each class, none of them held out.

    The sample is taken per class by a hash of doc_id; the bias is then set back to the classes' true rates. Executors
    turn these documents' whole texts into weights of subword buckets; the driver gets these alone. Should the sample have more
    than max_entries, the half of it that comes first by the hash is taken, until it has not. Contradicting or null labels
    are left out; of rows with one doc_id, one counts; documents of equal hash come in the order of doc_id.
    """
    clean = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z").select("doc_id", F.col("y").cast("int").alias("y"))
    clean = clean.where(in_fold(F.col("doc_id"), 4) != HELD_OUT)
    counts = {r.y: r.n for r in clean.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = clean.where("y = 0").orderBy(*order).limit(max_labels).unionByName(clean.where("y = 1").orderBy(*order).limit(max_labels))
    sample = _sampled(store.written(chosen, "chosen"), docs)
    share = 1.0
    while True:
        half = sample.where(F.xxhash64("doc_id") / 2.0**63 < 2 * share - 1)
        if (half.agg(F.sum("n")).first()[0] or 0) <= max_entries:
            break
        share /= 2
    table = half.select("doc_id", "y", "n", "buckets", "weights").toArrow()
    place = pc.sort_indices(table.column("doc_id")).to_numpy()
    y = table.column("y").to_numpy()[place].astype(float)
    first = np.concatenate([[0], np.cumsum(table.column("n").to_numpy()[place])]).astype(np.int64)

    def joined(name: str, kind: str) -> np.ndarray:
        held = [x.as_buffer() for x in table.column(name)]
        return np.concatenate([np.zeros(0, kind), *(np.frombuffer(held[i], kind) for i in place)])

    bucket, weight = joined("buckets", "<i4"), joined("weights", "<f4")
    del table
    model = train_bag(first, bucket, weight, y)
    tb.forget()
    if 0 < y.sum() < len(y):
        true, seen = counts[1] / counts[0], y.sum() / (len(y) - y.sum())
        return Bag(model.logits, model.bias + float(np.log(true / seen)))
    return model


def score(docs: DataFrame, model: Bag, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every whole text; null and empty texts get the prior.

    A narrow scan: the model of 2 MB goes out with the tasks. Only texts enter the score, so repeated rows and equal
    texts score alike, and other columns may have any name; texts of any length are read whole.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole):
                p = model.probability(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(in_fold(F.col("doc_id"), 4) == HELD_OUT, F.lit(False)).alias("held_out")
    return docs.select("doc_id", "text", held).mapInArrow(rows, f"doc_id {kind}, held_out boolean, score double, predicted int")
