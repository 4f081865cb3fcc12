"""Quality rules: gradient-boosted trees over document statistics, scored as flat numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelwright.llm import textbatch as tb

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
CONTINUES = (np.arange(256) & 0xC0) == 0x80

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios that the trees see, and the sign that the score must follow in each (0: free).
FEATURES = (
    ("log_words", 0),
    ("mean_word", 0),
    ("symbol_ratio", -1),
    ("dup_line_ratio", -1),
    ("repeat_ratio", -1),
    ("upper_ratio", -1),
    ("digit_ratio", 0),
    ("exclaim_ratio", -1),
    ("stop_ratio", 0),
    ("distinct_ratio", 0),
    ("words_per_line", 0),
)


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts and ratios of each text of a string column."""
    w = tb.Words(column)
    n, data, at = w.counts, w.data, w.at
    hashed = w.hashes()

    def of_bytes(flags: np.ndarray) -> np.ndarray:
        return tb.per_doc(flags.astype(np.int64), at)

    leads = ~CONTINUES[data]
    chars = of_bytes(leads)
    word_chars = of_bytes(leads & ~tb.BLANK[data])
    symbols = of_bytes(SYMBOLS[data])

    # lines: split at \n inside each text
    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.union1d(at[:-1], breaks + 1)
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data)) if len(line_starts) else line_starts
    line_ends = line_ends - (data[line_ends - 1] == 0x0A)
    line_doc = np.searchsorted(at, line_starts, side="right") - 1
    has_word = np.searchsorted(w.starts, line_ends) > np.searchsorted(w.starts, line_starts)
    line_doc, line_hash = line_doc[has_word], tb.span_hashes(data, line_starts[has_word], line_ends[has_word])
    lines = np.bincount(line_doc, minlength=w.n_docs)
    once = np.bincount(_distinct_owner(line_doc, line_hash), minlength=w.n_docs)

    start, window = tb.windows(hashed, w.doc, 3)
    again = _repeated(w.doc[start], window)
    cover = np.zeros(len(w) + 3, np.int64)
    for k in range(3):
        cover[start[again] + k] = 1
    repeat = tb.per_doc(cover[: len(w)], w.first)

    words = np.maximum(n, 1)
    lengths = w.ends - w.starts
    return {
        "n_words": n.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": symbols,
        "n_dup_lines": lines - once,
        "n_repeat_words": repeat,
        "log_words": np.log1p(n),
        "mean_word": word_chars / words,
        "symbol_ratio": symbols / words,
        "dup_line_ratio": (lines - once) / np.maximum(lines, 1),
        "repeat_ratio": repeat / words,
        "upper_ratio": of_bytes((data >= 0x41) & (data <= 0x5A)) / np.maximum(chars, 1),
        "digit_ratio": of_bytes((data >= 0x30) & (data <= 0x39)) / np.maximum(chars, 1),
        "exclaim_ratio": of_bytes((data == 0x21) | (data == 0x3F)) / words,
        "stop_ratio": tb.per_doc((lengths <= 3).astype(np.int64), w.first) / words,
        "distinct_ratio": np.bincount(_distinct_owner(w.doc, hashed), minlength=w.n_docs) / words,
        "words_per_line": n / np.maximum(lines, 1),
    }


def _keys(doc: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    return tb.mix64(hashed + tb.mix64(doc.astype(np.uint64) + np.uint64(1)))


def _repeated(doc: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Flags of entries whose hash occurs at least twice in their row."""
    keys = _keys(doc, hashed)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[place] == keys


def _distinct_owner(doc: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """The row of each entry that is the first of its kind in its row."""
    if not len(doc):
        return doc
    _, at = np.unique(_keys(doc, hashed), return_index=True)
    return doc[at]


@dataclass(frozen=True)
class Trees:
    """Boosted regression trees as one set of node arrays; leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of x; x has a column for each of FEATURES."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def boost(x: np.ndarray, y: np.ndarray, signs: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: int = 5) -> Trees:
    """Fit trees to 0/1 labels by second-order boosting over quantile bins.

    A split on a feature with a sign is refused where it would step against it; the bounds of both
    children meet at the mean of their values, so whole trees stay monotone. No rows, or rows of one
    class only, give a model without trees.
    """
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    rate_of_ones = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin = np.full(len(y), bias)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1) if len(x) else np.zeros((0, x.shape[1]), int)

    def leaf(v: float) -> int:
        at = len(feature)
        for store, item in ((feature, 0), (threshold, 0.0), (left, at), (right, at), (value, v)):
            store.append(item)
        return at

    def best(g, h, rows, lo, hi):
        """gain, feature, cut, value left, value right of the best split of rows; None without one."""
        found, whole = None, (g.sum() ** 2) / (h.sum() + l2)
        for j, cut in enumerate(cuts):
            if not len(cut):
                continue
            gs, hs, ns = (np.bincount(binned[rows, j], weights=v, minlength=len(cut) + 1) for v in (g, h, np.ones(len(rows))))
            gl, hl, nl = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1], np.cumsum(ns)[:-1]
            gr, hr, nr = g.sum() - gl, h.sum() - hl, len(rows) - nl
            vl, vr = np.clip(-gl / (hl + l2), lo, hi), np.clip(-gr / (hr + l2), lo, hi)
            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - whole
            gain[(nl < least) | (nr < least) | (signs[j] * (vr - vl) < 0)] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > 1e-6 and (found is None or gain[k] > found[0]):
                found = gain[k], j, k, vl[k], vr[k]
        return found

    def grow(rows, g, h, lo, hi, levels) -> int:
        split = best(g[rows], h[rows], rows, lo, hi) if levels else None
        if split is None:
            v = float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), lo, hi)) * rate
            margin[rows] += v
            return leaf(v)
        _, j, k, vl, vr = split
        at = leaf(0.0)
        middle = (vl + vr) / 2
        go = binned[rows, j] <= k
        bounds = {1: ((lo, middle), (middle, hi)), -1: ((middle, hi), (lo, middle))}.get(int(signs[j]), ((lo, hi), (lo, hi)))
        feature[at], threshold[at] = j, float(cuts[j][k])
        left[at] = grow(rows[go], g, h, *bounds[0], levels - 1)
        right[at] = grow(rows[~go], g, h, *bounds[1], levels - 1)
        return at

    if len(y) and 0 < y.sum() < len(y):
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), -4.0, 4.0, depth))
    return Trees(np.array(feature, int), np.array(threshold), np.array(left, int), np.array(right, int), np.array(value), np.array(roots, int), depth, bias)


def matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([np.asarray(stats[name], np.float64) for name, _ in FEATURES], axis=1)


def sample_labels(labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most `most` labelled documents, chosen by a hash of doc_id; one row for each doc_id.

    A doc_id with null or with contradicting labels is left out.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_z")).where("y = _z")
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", F.col("y").cast("int").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, label: str = "quality") -> Trees:
    """Trees from at most max_labels labelled documents, a row of numbers each: the bound on what reaches the driver.

    Of rows with one doc_id, the one with the least numbers counts. Null and empty texts have counts of 0.
    """
    chosen = F.broadcast(sample_labels(labels, label, max_labels))  # at most max_labels rows of 12 bytes
    schema, kind = ", ".join(["y int", *(f"{name} double" for name, _ in FEATURES)]), dict(docs.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole):
                x = statistics(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *(pa.array(np.asarray(x[n], np.float64)) for n, _ in FEATURES)], names=["doc_id", "y", *(n for n, _ in FEATURES)])

    got = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "y", "text").mapInArrow(rows, f"doc_id {kind}, {schema}")
    least = got.groupBy("doc_id").agg(F.min(F.struct("y", *(n for n, _ in FEATURES))).alias("x"))  # repeated rows meet before they are sent
    got = least.select("x.*").toArrow()
    x = np.stack([got.column(n).to_numpy() for n, _ in FEATURES], axis=1)
    y = got.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # rows come in any order; trees must not depend on it
    return boost(x[order], y[order], np.array([s for _, s in FEATURES]))


def passes(x: dict[str, np.ndarray], trees: Trees, threshold: float, min_words: int, max_repeat_percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base failures, probabilities and verdicts of texts with these statistics."""
    failed = (x["n_words"] < min_words) | (100 * x["n_repeat_words"] > max_repeat_percent * x["n_words"])
    p = trees.probability(matrix(x))
    return failed, p, ~failed & (p >= threshold)


def keep_good(docs: DataFrame, trees: Trees, threshold: float = 0.5, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """The rows of docs that `score` would keep, with the columns of docs as they are, whatever their names.

    A text alone decides, so repeated rows stay or go together; null and empty texts go, having too few words.
    Texts of any length are judged whole. An empty table gives an empty one.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole):
                yield batch.filter(pa.array(passes(statistics(batch.column("text")), trees, threshold, min_words, max_repeat_percent)[2]))

    return docs.mapInArrow(rows, docs.schema)


def score(docs: DataFrame, trees: Trees, threshold: float = 0.5, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """docs with word and repetition counts, the trees' probability of good quality, and the verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed (too few words or
    too much repetition), quality_score and kept (not base_failed, and a score of at least threshold).
    Columns of docs with these names are replaced. A null or empty text has counts of 0 and fails. A narrow scan: the text alone
    decides, so repeated rows and equal texts fare alike; a score of just threshold is kept. Texts of any length are read
    whole; an empty table gives an empty one.
    """
    added = {**{name: "long" for name in COUNTS}, "base_failed": "boolean", "quality_score": "double", "kept": "boolean"}
    keep = docs.drop(*added)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema), *(f"{k} {v}" for k, v in added.items())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole):
                x = statistics(batch.column("text"))
                verdict = passes(x, trees, threshold, min_words, max_repeat_percent)
                more = [*(pa.array(np.asarray(x[n], np.int64)) for n in COUNTS), *map(pa.array, verdict)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *added])

    return keep.mapInArrow(rows, schema)
