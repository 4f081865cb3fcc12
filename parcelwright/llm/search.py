"""Ranked lexical search: posting lists cut into geometric blocks with coordinatewise-maximum summaries, skipped by exact bounds."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from parcelwright.llm import textbatch as tb, tokens
from parcelwright.sources import workspace as store

#: Documents of a posting list that share a summary, about.
BLOCK = 32
#: Documents of a shard: its lists, summaries and marks are in one task's memory.
SHARD_DOCS = 4096
#: Dimensions of the sketches by whose distance documents of a list are grouped.
SKETCH = 16
#: Items that are searched together, and words of theirs at most: what is sent to tasks.
ITEMS, ITEM_WORDS = 1024, 1 << 16
#: Parts into which an item's candidates are dealt before the last ranking.
SALTS = 64


def words_of(column: pa.Array) -> tb.Words:
    return tb.Words(column, tb.NOT_ALNUM, lower=True)


class Vocabulary:
    """Terms of a block of items. Terms are told apart by 64-bit hashes and confirmed by their bytes."""

    def __init__(self, texts: list[str | None]):
        found = words_of(pa.array(texts, pa.string()))
        terms = sorted({found.token(i) for i in range(len(found))})
        hashes = words_of(pa.array([t.decode() for t in terms], pa.string())).hashes()
        order = np.argsort(hashes)
        self.hashes, self.terms = hashes[order], [terms[i] for i in order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms share a hash")
        self.items = [np.unique(self.find(words_of(pa.array([t], pa.string()))), return_counts=True) for t in texts]

    def find(self, words: tb.Words) -> np.ndarray:
        """The number of each word's term, -1 where it is none."""
        if not self.terms or not len(words):
            return np.full(len(words), -1)
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.terms) - 1)
        hit = self.hashes[at] == hashes
        sizes = np.fromiter(map(len, self.terms), np.int64, len(self.terms))
        hit &= sizes[at] == words.ends - words.starts
        places = np.flatnonzero(hit)
        flat = np.frombuffer(b"".join(self.terms), np.uint8)
        first = np.cumsum(sizes) - sizes
        own = sizes[at[places]]
        same = flat[tokens.gathered(first[at[places]], own)] == words.data[tokens.gathered(words.starts[places], own)]
        wrong = np.add.reduceat(~same, np.cumsum(own) - own) > 0 if len(places) else np.zeros(0, bool)
        hit[places[wrong]] = False
        return np.where(hit, at, -1)


def vectors(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Documents as sparse vectors over a block's terms: doc_id, n (all terms), terms and tfs (little-endian 32-bit numbers).

    Documents without any term at all are left out: they neither count nor rank.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch):
                words = words_of(part.column("text"))
                term = vocabulary.find(words)
                known = term >= 0
                key, tf = np.unique(words.doc[known] * (len(vocabulary.terms) + 1) + term[known], return_counts=True)
                doc, term = np.divmod(key, len(vocabulary.terms) + 1)
                ends = 4 * np.cumsum(np.bincount(doc, minlength=words.n_docs))
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                binary = [pa.Array.from_buffers(pa.binary(), words.n_docs, [None, pa.py_buffer(offsets), pa.py_buffer(x.astype("<i4"))]) for x in (term, tf)]
                out = pa.record_batch([part.column("doc_id"), pa.array(words.counts), *binary], names=["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(words.counts > 0))

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()), T.StructField("terms", T.BinaryType()), T.StructField("tfs", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def document_counts(table: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term of a block; a sum of one row a term and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms, np.int64)
        for batch in batches:
            raw, _ = tb.column_bytes(batch.column("terms"))
            counts += np.bincount(np.frombuffer(raw.tobytes(), "<i4"), minlength=n_terms)
        term = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(term), pa.array(counts[term])], names=["term", "docs"])

    df = np.zeros(n_terms, np.int64)
    for term, docs in table.select("terms").mapInArrow(run, "term long, docs long").groupBy("term").agg(F.sum("docs")).collect():
        df[term] = docs
    return df


def sketches(term: np.ndarray, value: np.ndarray, first: np.ndarray, n_terms: int) -> np.ndarray:
    """A few random projections of each vector, of length 1: near vectors have near sketches."""
    signs = np.random.default_rng(0).standard_normal((n_terms, SKETCH)).astype(np.float32)
    total = np.zeros((len(term) + 1, SKETCH))
    np.cumsum(signs[term] * value[:, None].astype(np.float32), axis=0, out=total[1:])
    out = np.diff(total[first], axis=0)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def clustered(members: np.ndarray, sketch: np.ndarray, block: int) -> list[np.ndarray]:
    """A posting list in blocks: each document goes with the nearest of evenly drawn leaders; a full cluster is cut."""
    if len(members) <= block:
        return [members]
    leaders = sketch[members[:: block]]
    near = np.argmax(sketch[members] @ leaders.T, axis=1)
    order = np.argsort(near, kind="stable")
    out = []
    for cluster in np.split(members[order], np.flatnonzero(np.diff(near[order])) + 1):
        out += [cluster[i : i + block] for i in range(0, len(cluster), block)]
    return out


class Shard:
    """Some thousand documents with their posting lists over a block of items' terms."""

    def __init__(self, sizes: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.term, self.impact, self.n_terms = term, impact, n_terms
        self.n = len(sizes)
        doc = np.repeat(np.arange(self.n), sizes)
        order = np.argsort(term, kind="stable")
        self.lists = np.split(doc[order], np.cumsum(np.bincount(term, minlength=n_terms))[:-1]) if n_terms else []
        self.most = np.zeros(n_terms, np.int64)
        np.maximum.at(self.most, term, impact)
        self.sketch = sketches(term, impact, self.first, n_terms)

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents' coordinates, and how many each has."""
        sizes = self.first[docs + 1] - self.first[docs]
        return tokens.gathered(self.first[docs], sizes), sizes

    def blocks(self, t: int, block: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The posting list of t in blocks, and each block's summary: the largest impact of every term in it."""
        made = clustered(self.lists[t], self.sketch, block)
        places, sizes = self.entries(np.concatenate(made))
        of = np.repeat(np.repeat(np.arange(len(made)), [len(b) for b in made]), sizes)
        summary = np.zeros((len(made), self.n_terms), np.int64)
        np.maximum.at(summary, (of, self.term[places]), self.impact[places])
        return made, summary

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        places, sizes = self.entries(docs)
        total = np.concatenate([[0], np.cumsum(weights[self.term[places]] * self.impact[places])])
        return np.diff(total[np.concatenate([[0], np.cumsum(sizes)])])


class Best:
    """The k best documents of an item so far: highest scores, then least doc_ids."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple] = []  # (-score, has no doc_id, doc_id)

    @property
    def least(self) -> int:
        """A score below which nothing can enter any more."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, doc_ids: list) -> None:
        enter = np.flatnonzero(scores >= self.least)
        if len(enter):
            self.rows = sorted(self.rows + [(-int(scores[i]), doc_ids[i] is None, 0 if doc_ids[i] is None else doc_ids[i]) for i in enter])[: self.k]


def search_shard(shard: Shard, doc_ids: list, items: list[tuple[np.ndarray, np.ndarray]], best: list[Best], weights: np.ndarray, block: int, stats: dict | None = None) -> None:
    """Add a shard's documents to the best of each item.

    Lists are visited in the order of falling term weights. A document is judged for an item in the first of the item's lists
    that it is in, so later lists are bounded without the terms before. A list is passed over if even its largest impacts
    can't reach an item's least kept score, and a block of it if its summary can't; equal scores may still enter.
    """
    order = np.lexsort((np.arange(shard.n_terms), -weights))
    rank = np.argsort(order)
    of_term: dict[int, list[int]] = {}
    own = []
    for i, (terms, repeats) in enumerate(items):
        keep = (weights[terms] > 0) & (shard.most[terms] > 0)
        terms, repeats = terms[keep], repeats[keep]
        by = np.argsort(rank[terms])
        terms, value = terms[by], (weights[terms] * repeats)[by]
        own.append((terms, value, np.cumsum((value * shard.most[terms])[::-1])[::-1]))
        for place, t in enumerate(terms):
            of_term.setdefault(int(t), []).append((i, place))
    judged = {i: np.zeros(shard.n, bool) for i in range(len(items))}
    for t in sorted(of_term, key=rank.__getitem__):
        asked = [(i, place) for i, place in of_term[t] if own[i][2][place] >= best[i].least]
        if not asked:
            continue
        blocks, summary = shard.blocks(t, block)
        for i, place in asked:
            terms, value, _ = own[i]
            bound = summary[:, terms[place:]] @ value[place:]
            dense = None
            for b in np.argsort(-bound, kind="stable"):
                if bound[b] < best[i].least:
                    break
                docs = blocks[b][~judged[i][blocks[b]]]
                judged[i][docs] = True
                if stats is not None:
                    stats["scored"] = stats.get("scored", 0) + len(docs)
                if len(docs):
                    if dense is None:
                        dense = np.zeros(shard.n_terms, np.int64)
                        dense[terms] = value
                    best[i].add(shard.scores(docs, dense), [doc_ids[d] for d in docs])
        if stats is not None:
            stats["lists"] = stats.get("lists", 0) + 1


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What an occurrence count weighs in a document of n terms; m is the document's length against the mean, damped."""
    m = 25 + (75 * n * n_docs) // max(n_words, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def candidates(table: DataFrame, vocabulary: Vocabulary, item_ids: list, item_type: T.DataType, df: np.ndarray, n_docs: int, n_words: int, k: int, block: int, shard_docs: int) -> DataFrame:
    """Each task's k best documents of every item. The best of one shard raise the bar for the next."""
    weights = term_weights(n_docs, df)
    n_terms = len(vocabulary.terms)
    items = [(terms, repeats) for terms, repeats in vocabulary.items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, shard_docs):
                part = batch.slice(at, shard_docs)
                raw, offsets = tb.column_bytes(part.column("terms"))
                tf = np.frombuffer(tb.column_bytes(part.column("tfs"))[0].tobytes(), "<i4").astype(np.int64)
                sizes = np.diff(offsets) // 4
                n = np.repeat(part.column("n").to_numpy(), sizes)
                shard = Shard(sizes, np.frombuffer(raw.tobytes(), "<i4").astype(np.int64), impacts(tf, n, n_docs, n_words), n_terms)
                search_shard(shard, part.column("doc_id").to_pylist(), items, best, weights, block)
        rows = [(item_ids[i], None if none else doc_id, -score) for i, b in enumerate(best) for score, none, doc_id in b.rows]
        if rows:
            ids, docs, scores = zip(*rows)
            yield pa.record_batch([pa.array(ids, kinds[0]), pa.array(docs, id_type), pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(item_type)]
    schema = T.StructType([T.StructField("item_id", item_type), T.StructField("doc_id", table.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
    return table.mapInArrow(run, schema)


def item_blocks(items: DataFrame) -> Iterator[list]:
    """Items in blocks of bounded count and words, as they come to the driver one partition at a time."""
    block, words = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        n = len(row.text or "") // 2 + 1  # words at most
        if block and (len(block) >= ITEMS or words + n > ITEM_WORDS):
            yield block
            block, words = [], 0
        block.append(row)
        words += n
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score.

    Items are searched in blocks of bounded size, each against all documents. Documents become vectors over a block's terms, written
    once; counts of documents and words give weights. Each task then cuts its posting lists into blocks of similar
    documents, with summaries, and keeps the k best of each item; only these are shuffled, in two steps.

    Null texts and texts without a term neither count nor rank; items without a term, or whose terms no document holds, get no
    rows. Repeated documents rank each; equal scores rank by doc_id, those without one last. Repeated items (rows) are
    answered each. Columns but doc_id, item_id and text are not read; an empty table on either side gives no rows.
    """
    spark, item_type = docs.sparkSession, items.schema["item_id"].dataType
    out = None
    for rows in item_blocks(items):
        vocabulary = Vocabulary([r.text for r in rows])
        tb.forget()
        table = store.written(vectors(docs, vocabulary), "vectors")
        n_docs, n_words = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = document_counts(table, len(vocabulary.terms))
        numbered = candidates(table, vocabulary, list(range(len(rows))), T.LongType(), df, n_docs, n_words, k, block, shard_docs).withColumnRenamed("item_id", "item")
        salted = numbered.withColumn("salt", F.spark_partition_id() % SALTS)
        order = (F.desc("score"), F.asc_nulls_last("doc_id"))
        top = salted.withColumn("rank", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
        top = top.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_type)]))
        found = names.join(top, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.LongType())]))
    return out
