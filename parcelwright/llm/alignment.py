"""Cross-tokenizer alignment: groups of tokens between common byte ends, links of overlapping tokens, and their counts."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from parcelwright.llm import textbatch as tb, tokens
from parcelwright.sources import workspace as store

#: Distinct segments whose groups a task keeps; beyond, it starts anew.
KEPT_SEGMENTS = 1 << 20
#: An id pair is one number: the first id times this, and the second.
SECOND = 1 << 20
#: Bytes over which a segment goes to the slower encoder, whose pattern needs no stack.
LONG = 1 << 16
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


class ByteLevel:
    """Ids of a byte-level BPE vocabulary, and the bytes of each."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        file = tokens.vocabulary_file(vocabulary)
        with open(file, encoding="utf-8") as f:
            known = json.load(f)["model"]["vocab"]
        printed = sorted(pre_tokenizers.ByteLevel.alphabet())
        kept = [c for c in printed if ord(c) < 256]  # bytes that stand for themselves; the others follow from 256 on, in order
        byte = {c: ord(c) for c in kept} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(map(ord, kept))))}
        self.slow = Tokenizer.from_file(file)
        self.slow.encode_special_tokens = True
        special = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        ranks = {bytes(byte[c] for c in token): i for token, i in known.items() if token not in special}
        self.fast = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(known.values()) + 1)
        for b, i in ranks.items():
            self.bytes[i] = b

    def encode(self, segments: list[str]) -> list[list[int]]:
        return [self.fast.encode_ordinary(s) if len(s) < LONG else self.slow.encode(s, add_special_tokens=False).ids for s in segments]


class Pieces:
    """Ids of a sentence-piece vocabulary, and the bytes of each."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary_file(vocabulary))
        ids = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(i) for i in ids]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)]
        #: No piece holds a space after another character, so that merges never cross from a word to a space.
        self.ends_words = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Segments begin with the space that the model adds."""
        return self.model.encode([s[1:] for s in segments], num_threads=1)


def segment_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where segments begin: each text, and each space after a character that is no white space, but for spaces that end a text.

    Neither pattern nor merges of a vocabulary reach across such a place, so segments are encoded alone. What might be
    white space counts as such: bytes up to 0x20, and the multi-byte forms that begin as those of Unicode's spaces do.
    """
    n = len(raw)
    space = raw == 0x20
    if not n:
        return np.zeros(0, np.int64)
    b1, b2, b3 = (np.concatenate([np.full(k, 0x20, np.uint8), raw[:-k]]) if n > k else np.full(n, 0x20, np.uint8) for k in (1, 2, 3))
    blank = (b1 <= 0x20) | (b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0)) | (b3 == 0xE1) & (b2 == 0x9A) & (b1 == 0x80) | (b3 == 0xE2) & ((b2 == 0x80) | (b2 == 0x81)) | (b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x80)
    start = space & ~blank
    solid = np.concatenate([[0], np.cumsum(~space)])
    places = np.flatnonzero(start)
    end = at[np.searchsorted(at, places, "right")]
    start[places[solid[end] == solid[places]]] = False
    full = at[:-1][np.diff(at) > 0]
    start[full] = True
    return np.flatnonzero(start)


def groups(a: list[int], b: list[int], a_size: list[int], b_size: list[int]) -> Iterator[tuple[list[int], list[int], list[tuple]]]:
    """Slices of both id lists between byte ends that they share, and each slice's links.

    Dictionaries lead from cumulative ends to token indices; the keys that both have, sorted, cut the lists. Inside a slice no
    end is common, so of two tokens that overlap the one that ends first gives way to its next.
    """
    a_end = dict(zip(accumulate(map(a_size.__getitem__, a)), range(1, len(a) + 1)))
    b_end = dict(zip(accumulate(map(b_size.__getitem__, b)), range(1, len(b) + 1)))
    i = j = 0
    for end in sorted(a_end.keys() & b_end.keys()):
        left, right = a[i : a_end[end]], b[j : b_end[end]]
        i, j = a_end[end], b_end[end]
        if len(left) == 1 or len(right) == 1:
            yield left, right, [(x, y) for x in left for y in right]
            continue
        x = y = 0
        x_end, y_end, links = a_size[left[0]], b_size[right[0]], [(left[0], right[0])]
        while x + 1 < len(left) or y + 1 < len(right):
            if x_end < y_end:
                x += 1
                x_end += a_size[left[x]]
            else:
                y += 1
                y_end += b_size[right[y]]
            links.append((left[x], right[y]))
        yield left, right, links


class Aligner:
    """Alignments of whole texts, put together from those of their distinct segments."""

    def __init__(self, first: str, second: str):
        self.a, self.b = ByteLevel(first), Pieces(second)
        self.a_size, self.b_size = [len(x) for x in self.a.bytes], [len(x) for x in self.b.bytes]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.shown: list[str] = []
        self.numbers = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, one if bytes differ
        self.pairs = np.zeros(0, np.int64)

    def _learn(self, segments: list[str]) -> None:
        numbers, pairs = [], []
        for s, a, b in zip(segments, self.a.encode(segments), self.b.encode(segments)):
            own = s.encode()
            if b"".join(map(self.a.bytes.__getitem__, a)) != own or b"".join(map(self.b.bytes.__getitem__, b)) != own:
                self.shown.append("")
                numbers.append((0, 0, 0, 0, 1))
                continue
            shown, before = [], len(pairs)
            for left, right, links in groups(a, b, self.a_size, self.b_size):
                shown.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                pairs += [x * SECOND + y for x, y in links]
            self.shown.append(";".join(shown))
            numbers.append((len(a), len(b), len(shown), len(pairs) - before, 0))
        self.place.update(zip(segments, range(len(self.place), len(self.place) + len(segments))))
        self.numbers = np.concatenate([self.numbers, np.array(numbers, np.int64).reshape(-1, 5)])
        self.pairs = np.concatenate([self.pairs, np.array(pairs, np.int64)])
        self.first = np.cumsum(self.numbers[:, 3]) - self.numbers[:, 3]

    def align(self, column: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text: its numbers (NUMBERS), its groups as text; of all texts end to end: the text and the id pair of each link.

        Null and empty texts, and those whose bytes either vocabulary doesn't give back, have no tokens.
        """
        if len(self.place) > KEPT_SEGMENTS:
            self.forget()
        text = pc.fill_null(column, "")
        raw, at = tb.column_bytes(pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise("", text, " ")))
        starts = segment_starts(raw, at) if self.b.ends_words else at[:-1][np.diff(at) > 0]
        ends = np.append(starts, len(raw)).astype(np.int64)
        told = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        distinct = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        unseen = [s for s in distinct if s not in self.place]
        if unseen:
            self._learn(unseen)
        places = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))[told.indices.to_numpy()]
        first = np.searchsorted(starts, at)
        n = len(column)
        doc = np.repeat(np.arange(n), np.diff(first))
        numbers = np.zeros((n, 5), np.int64)
        if len(places):
            np.add.at(numbers, doc, self.numbers[places])
        whole = numbers[:, 4] == 0
        numbers[~whole] = 0
        shown = [";".join(map(self.shown.__getitem__, places[lo:hi].tolist())) if ok else "" for lo, hi, ok in zip(first, first[1:], whole)]
        places, doc = places[whole[doc]], doc[whole[doc]]
        sizes = self.numbers[places, 3]
        links = self.pairs[tokens.gathered(self.first[places], sizes)] if len(places) else self.pairs[:0]
        return numbers[:, :4], shown, np.repeat(doc, sizes), links


def planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, a plane for each of their bytes: what is small packs well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def chunk_row(doc_ids: pa.Array, numbers: np.ndarray, shown: list[str], doc: np.ndarray, pair: np.ndarray) -> dict:
    """One slice of texts: of its distinct pairs, how many texts hold each; of each text, its pairs and how often it has each."""
    distinct, code = np.unique(pair, return_inverse=True)
    held, times = np.unique(doc * max(1, len(distinct)) + code, return_counts=True)
    held_doc, held_code = np.divmod(held, max(1, len(distinct)))
    sizes = np.bincount(held_doc, minlength=len(numbers))
    steps = np.diff(held_code, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[first] = held_code[first]
    return {
        "doc_ids": doc_ids.to_pylist(), "numbers": numbers.astype("<i8").tobytes(), "hashes": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown],
        "pairs": np.diff(distinct, prepend=0).astype("<i8").tobytes(), "docs": planes(np.bincount(held_code, minlength=len(distinct))), "sizes": planes(sizes), "steps": planes(steps), "times": planes(times),
    }


def pairs_of(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i8"))


def chunks(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Aligned slices of the scan's tasks, a row each: chunk, doc_ids, and packed arrays (chunk_row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = Aligner(first, second)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            kind = pa.list_(batch.schema.field("doc_id").type)
            for part in tb.slices(batch, most=tokens.SLICE_BYTES):
                row = chunk_row(part.column("doc_id"), *aligner.align(part.column("text")))
                arrays = {"chunk": pa.array([chunk], pa.int64())} | {k: pa.array([v], kind if k == "doc_ids" else pa.list_(pa.string()) if k == "hashes" else pa.binary()) for k, v in row.items()}
                yield pa.record_batch(list(arrays.values()), names=list(arrays))
                chunk += 1

    binary = [T.StructField(n, T.BinaryType()) for n in ("pairs", "docs", "sizes", "steps", "times")]
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), T.StructField("numbers", T.BinaryType()), T.StructField("hashes", T.ArrayType(T.StringType())), *binary])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("chunk", "pairs", "docs"))):
            pair = pairs_of(pairs)
            yield pa.record_batch([pa.array(np.full(len(pair), chunk)), pa.array(pair), pa.array(from_planes(docs))], names=["chunk", "pair", "docs"])


def finished(kind: T.DataType):
    """Sums of each text's links over their pairs' counts, from a chunk and the counts of its pairs."""

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        order = np.argsort(right.column("pair").to_numpy())
        count, best = right.column("n").to_numpy()[order], right.column("best").to_numpy().astype(np.int64)[order]
        for row in left.to_pylist():
            sizes, times = from_planes(row["sizes"]), from_planes(row["times"])
            first = (np.cumsum(sizes) - sizes)[sizes > 0]
            steps = from_planes(row["steps"])
            total = np.cumsum(steps)
            code = total - np.repeat((total - steps)[first], sizes[sizes > 0]) if len(steps) else steps
            ends = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for x in (times * best[code], times * count[code])]
            numbers = np.frombuffer(row["numbers"], "<i8").reshape(-1, 4)
            columns = {"doc_id": pa.array(row["doc_ids"], left.schema.field("doc_ids").type.value_type)} | {n: pa.array(numbers[:, i]) for i, n in enumerate(NUMBERS)} | {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1]), "groups_sha256": pa.array(row["hashes"], pa.string())}
            out.append(pa.table(columns))
        return pa.concat_tables(out) if out else empty

    fields = T.StructType([T.StructField("doc_id", kind), *(T.StructField(n, T.LongType()) for n in (*NUMBERS, "n_best", "count_sum")), T.StructField("groups_sha256", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(fields).empty_table()
    return finish, fields


def align(docs: DataFrame, first: str = "byte_bpe_50k.json", second: str = "piece_bpe_32k.model") -> DataFrame:
    """Alignment of each text between two vocabularies: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both vocabularies encode a space and the text. Where tokens of both end at one byte, groups end; tokens that overlap are
    linked. An id pair counts in how many documents (rows) it is linked; n_best are links whose count is the highest of
    their first id, ties included, and count_sum adds up counts over links.

    Slices of 8 MB of text are aligned where they are read and written once, a row a slice. Of each slice its distinct pairs go out
    to be counted and come back with corpus-wide counts; links themselves are never shuffled one by one. A pair or an
    id is in a slice's message once, so no key gathers more than a row a slice.

    Null and empty texts, and those that either vocabulary doesn't give back byte by byte, have no tokens: zeros and ''. Rows are
    aligned one by one, so repeated rows count each. Columns but doc_id and text are not read; an empty table gives no rows.
    """
    table = store.written(chunks(docs, first, second), "aligned")
    seen = table.select("chunk", "pairs", "docs").mapInArrow(unpacked, "chunk long, pair long, docs long")
    counts = seen.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.floor(F.col("pair") / SECOND).cast("long"))
    counts = store.written(counts.select("pair", "n", (F.col("n") == F.max("n").over(W.partitionBy("a"))).alias("best")), "pair-counts")
    answers = seen.select("chunk", "pair").join(counts, "pair")
    finish, fields = finished(docs.schema["doc_id"].dataType)
    return table.drop("pairs", "docs").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, fields)


def links(docs: DataFrame, first: str = "byte_bpe_50k.json", second: str = "piece_bpe_32k.model") -> DataFrame:
    """Id pairs of the corpus: a, b, n_docs. The same counts that align uses, for building a token map between vocabularies."""
    table = chunks(docs, first, second).select("chunk", "pairs", "docs").mapInArrow(unpacked, "chunk long, pair long, docs long")
    counted = table.groupBy("pair").agg(F.sum("docs").alias("n_docs"))
    return counted.select(F.floor(F.col("pair") / SECOND).cast("int").alias("a"), F.pmod("pair", F.lit(SECOND)).cast("int").alias("b"), "n_docs")
