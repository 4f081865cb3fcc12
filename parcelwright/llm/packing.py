"""Packing documents into windows of one size by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, functions as F, types as T

from parcelwright.llm import textbatch as tb, tokens

CAPACITY = 4096
#: Windows that are filled together.
GROUP = 64
#: Tokens a window of a full group lacks on average, which leaves room for imbalance.
SLACK = 16
#: Share of padding of a group up to which the window count rises; beyond, pieces are halved first.
WASTE = 0.02


def difference(sizes: list[int], k: int) -> np.ndarray:
    """The window (0 to k - 1) of each size, near-equal in sum: largest differencing of k-way partial partitions.

    Each size begins as a partial partition of k sums, all but one zero. The two partitions of the widest spreads merge, the
    largest sum of one with the smallest of the other, until one is left; what each merge joined is then followed back.
    """
    sums = np.zeros((2 * len(sizes), k), np.int64)
    sums[: len(sizes), -1] = sizes
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    at = len(sizes)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        order = np.argsort(both, kind="stable")
        both = both[order]
        sums[at] = both - both[0]  # equal shares don't matter to a spread
        merged.append((a, b, order))
        heapq.heappush(heap, (int(both[0] - both[-1]), at))
        at += 1
    window = np.zeros((at, k), np.int32)
    window[at - 1] = np.arange(k)
    for node in range(at - 1, len(sizes) - 1, -1):
        a, b, order = merged[node - len(sizes)]
        window[a][order] = window[node]
        window[b][k - 1 - order] = window[node]
    return window[: len(sizes), -1]


def halves(pieces: list[tuple], most: int) -> list[tuple]:
    """Pieces (document, start, length), those over most cut into equal parts."""
    out = []
    for doc, start, n in pieces:
        parts = -(-n // most)
        cuts = [n * i // parts for i in range(parts + 1)]
        out += [(doc, start + a, b - a) for a, b in zip(cuts, cuts[1:])]
    return out


def bundles(pieces: list[tuple], least: int) -> list[list[tuple]]:
    """Pieces in runs of at least `least` tokens, so that many tiny documents make few sizes; the last may have fewer."""
    out: list[list[tuple]] = []
    have = least
    for piece in pieces:
        if have >= least:
            out.append([])
            have = 0
        out[-1].append(piece)
        have += piece[2]
    return out


def fill(pieces: list[tuple], capacity: int = CAPACITY, waste: float = WASTE) -> list[list[tuple]]:
    """Windows of at most capacity tokens that hold all pieces.

    The window count starts at the least that could hold them and rises while differencing leaves a window over capacity. Where
    that would pad more than `waste` of the windows, the longest pieces are halved and differencing begins again.
    """
    total = sum(n for _, _, n in pieces)
    least = -(-total // capacity)
    allowed = max(least, int(total / (capacity * (1 - waste))))
    most = capacity
    while True:
        units = bundles(halves(pieces, most), max(1, min(most, capacity) // 64))
        sizes = [sum(n for _, _, n in unit) for unit in units]
        for k in range(least, allowed + 1):
            window = difference(sizes, k)
            if np.bincount(window, sizes, k).max() <= capacity:
                out: list[list[tuple]] = [[] for _ in range(k)]
                for unit, w in zip(units, window):
                    out[w] += unit
                return [w for w in out if w]
        most = max(1, most // 2)


class Packer:
    """Windows from a stream of (document, tokens): full windows of long documents at once, what is left of documents in groups."""

    def __init__(self, capacity: int, group: int, slack: int, waste: float):
        self.capacity, self.group, self.slack, self.waste = capacity, group, slack, waste
        self.waiting: list[tuple] = []
        self.tokens = 0

    def add(self, doc, n: int) -> Iterator[list[tuple]]:
        start = 0
        while n - start >= self.capacity:
            yield [(doc, start, self.capacity)]
            start += self.capacity
        full = self.group * (self.capacity - self.slack)
        while start < n:
            part = min(n - start, full - self.tokens)
            self.waiting.append((doc, start, part))
            self.tokens += part
            start += part
            if self.tokens == full:
                yield from self.flush()

    def flush(self) -> Iterator[list[tuple]]:
        pieces, self.waiting, self.tokens = self.waiting, [], 0
        if pieces:
            yield from fill(pieces, self.capacity, self.waste)

    def end(self) -> Iterator[list[tuple]]:
        """The last group of a task: whole windows, then windows of powers of two, which need no padding."""
        pieces, rest = self.waiting, self.tokens % (self.capacity - self.slack)
        self.waiting, self.tokens = [], 0
        tail: list[tuple] = []
        while rest:
            doc, start, n = pieces.pop()
            part = min(n, rest)
            if part < n:
                pieces.append((doc, start, n - part))
            tail.insert(0, (doc, start + n - part, part))
            rest -= part
        if pieces:
            yield from fill(pieces, self.capacity, self.waste)
        left = sum(n for _, _, n in tail)
        while left:
            size = 1 << (left.bit_length() - 1)
            window: list[tuple] = []
            while size:
                doc, start, n = tail.pop(0)
                part = min(n, size)
                window.append((doc, start, part))
                if part < n:
                    tail.insert(0, (doc, start + part, n - part))
                size -= part
                left -= part
            yield window


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, capacity: int = CAPACITY, group: int = GROUP, slack: int = SLACK, waste: float = WASTE) -> DataFrame:
    """Pieces of all documents and their places in windows: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset.

    A document is its ids and end_id. Whatever fills a window alone does; the rest of documents is gathered in the order of
    the scan until `group` windows are full but for slack, and dealt to them by differencing. So nothing is shuffled, a task holds
    one slice of texts and one group, and a task that is run again packs alike. The last group of a task ends in
    windows of powers of two, which aren't padded. capacity is a power of two.

    Null and empty texts are end_id alone. Rows are packed one by one, so repeated rows and rows without doc_id keep pieces of
    their own. Columns but doc_id and text are not read; an empty table gives no piece. A text of any length is cut into
    windows; its ids are in memory at once.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = tokens.WordIds(vocabulary)
        packer = Packer(capacity, group, slack, waste)
        number = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        size = 0

        def put(window: list[tuple]) -> None:
            nonlocal number, size
            place = 0
            for (doc_id, ids), start, n in window:
                out.append((doc_id, start, n, ids[start : start + n].tobytes(), len(ids), number, place))
                place += n
            size += place
            number += 1

        def made() -> pa.RecordBatch:
            nonlocal size
            columns, size = list(zip(*out)), 0
            out.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            for part in tb.slices(batch, most=tokens.SLICE_BYTES):
                ids, sizes = words.encode(part.column("text"))
                ends = np.cumsum(sizes)
                for doc_id, lo, hi in zip(part.column("doc_id").to_pylist(), ends - sizes, ends):
                    own = np.empty(hi - lo + 1, "<u4")
                    own[:-1] = ids[lo:hi]
                    own[-1] = end_id
                    for window in packer.add((doc_id, own), len(own)):
                        put(window)
                    if size > 1 << 20:
                        yield made()
        for window in packer.end():
            put(window)
        if out:
            yield made()

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(n, T.BinaryType() if n == "ids" else T.LongType()) for n in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset"))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def windows(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Training windows of packed pieces: sequence_id, ids (as bytes, end to end), n_tokens, padding, and where documents begin in it.

    A window is at most capacity tokens, so what is gathered is bounded. An empty table gives no window.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start")))
    rows = pieces.groupBy("sequence_id").agg(ordered.alias("p"), F.sum("length").alias("n_tokens"))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1)
    return rows.select(
        "sequence_id",
        F.aggregate("p", F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids"),
        "n_tokens",
        F.when(power == 0, F.lit(0)).otherwise(capacity - F.col("n_tokens")).alias("padding"),
        F.transform("p", lambda x: F.struct(x["offset"].alias("offset"), x["doc_id"].alias("doc_id"), x["start"].alias("start"))).alias("documents"),
    )
