"""LM scoring: n-grams counted over the corpus into a sharded Elias-Fano trie, which is kept and queried."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelwright.llm import textbatch as tb
from parcelwright.sources import workspace as store

ORDER = 3
#: Bytes of text in a block: the unit of counting and of scoring.
BLOCK_BYTES = 8 << 20
#: n-grams that blocks ask of one shard, about, in one order.
SHARD_KEYS = 1_500_000
#: A block's message to a shard holds this many n-grams on average at least, so messages never outgrow n-grams.
MESSAGE_KEYS = 16
#: Bits of a word's key; of the context's hash and of the n-gram's own hash in the keys of longer n-grams, behind the shard's bits. The
#: own bits alone tell the children of one context apart, so they are many: of 200 000 in a shard, about 40 share a key.
WORD_BITS, CONTEXT_BITS, CHILD_BITS = 56, 8, 30
#: Upper bits of a key that pointers lead from: the context's and the first of the child's.
POINTER_BITS = 18
#: Weight of the shorter context's distribution, in counts, by order.
CONCENTRATION = {2: 1000.0, 3: 10.0}
#: Held out of training: crc32 of doc_id as text modulo FOLDS is 0.
FOLDS = 10

#: Stands for the token before a document too: a text begins where another ended.
_END = np.uint64(0x454E44)
#: log10 of counts up to 10^16 is kept in 16 bits, evenly; this code says that there is none.
_STEP = 16 / 65534
_ABSENT = np.uint16(65535)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def quantise(counts: np.ndarray) -> np.ndarray:
    return np.round(np.log10(counts) / _STEP).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    """Counts of codes; 0 where there is none. Exact up to some thousands, within 0.03 % beyond."""
    count = 10.0 ** (code * _STEP)
    return np.where(code == _ABSENT, 0.0, np.where(count < 1000, np.round(count), count))


def _deflated(values: np.ndarray) -> bytes:
    """Whole numbers, mostly alike, byte plane by byte plane."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes(), 1)


def _inflated(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(size, -1).T).view(kind).ravel()


def _pack(values: np.ndarray, bits: int) -> bytes:
    """The lowest `bits` bits of each value, one after the other, and 8 bytes for readers to run over."""
    wide = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - bits :]
    return np.packbits(wide).tobytes() + bytes(8)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit of that rank, from 0, in each 64-bit word."""
    word, rank, place = word.copy(), rank.astype(np.int64), np.zeros(len(word), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        far = rank >= below
        rank -= np.where(far, below, 0)
        word >>= np.where(far, width, 0).astype(np.uint64)
        place += np.where(far, width, 0)
    return place


class EliasFano:
    """A sorted uint64 sequence: low bits packed, the rest in unary, read in place from bytes or a memory map.

    The k-th one of the unary part stands for the k-th value, and its zeros end the runs of values with equal
    high bits, so both ends of such a run are found by select. The only thing that reading adds are
    counts of ones before each 64-bit word.
    """

    @staticmethod
    def encode(values: np.ndarray, low_bits: int | None = None) -> bytes:
        """The sequence's bytes. Without low_bits, it is taken from the range that the values fill."""
        n, first = len(values), int(values[0]) if len(values) and low_bits is None else 0
        if low_bits is None:
            low_bits = max(0, ((int(values[-1]) - first + 1) // n).bit_length() - 1) if n else 0
        shifted = values - np.uint64(first)
        ones = (shifted >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        size = (int(ones[-1]) + 2 if n else 1) + 63 & ~63
        bits = np.zeros(size, np.uint8)
        bits[ones] = 1
        unary = np.packbits(bits, bitorder="little").tobytes()
        return np.array([n, low_bits, first, len(unary)], "<u8").tobytes() + unary + _pack(shifted, low_bits)

    def __init__(self, raw):
        raw = np.frombuffer(raw, np.uint8) if not isinstance(raw, np.ndarray) else raw
        n, low_bits, first, unary = (int(x) for x in raw[:32].view("<u8"))
        self.n, self.low_bits, self.first = n, low_bits, first
        self.words = raw[32 : 32 + unary].view("<u8")
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        self.size = 32 + unary + -(-n * low_bits // 8) + 8
        tail = raw[32 + unary : self.size]
        self.eights = np.ndarray(len(tail) - 7, ">u8", tail, strides=(1,))

    def low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        return (self.eights[bit >> 3].astype(np.uint64) << (bit & 7).astype(np.uint64)) >> np.uint64(64 - self.low_bits)

    def access(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + _select_in_word(self.words[word], i - self.ones[word])
        return ((place - i).astype(np.uint64) << np.uint64(self.low_bits)) + self.low(i) + np.uint64(self.first)

    def before(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits below `high`: the pointer to that run of values."""
        zero = high.astype(np.int64) - 1
        word = np.minimum(np.searchsorted(self.zeros, zero, "right") - 1, len(self.words) - 1)
        inside = (zero >= 0) & (zero < self.zeros[-1])
        at = np.where(inside, word, 0)
        place = at * 64 + _select_in_word(~self.words[at], np.where(inside, zero - self.zeros[at], 0))
        return np.where(zero < 0, 0, np.where(inside, place - zero, self.n))

    def decode(self) -> np.ndarray:
        """All values at once, for messages, which are read whole."""
        ones = np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))
        i = np.arange(self.n)
        return ((ones - i).astype(np.uint64) << np.uint64(self.low_bits)) + self.low(i) + np.uint64(self.first)


class Level:
    """One shard of a level of the trie: the children of all contexts whose keys fall into it.

    A child's key is the hash of its context, cut to CONTEXT_BITS, and a code of the child relative to it.
    Keys are one Elias-Fano sequence whose high bits are the contexts and the first bits of the children's codes: its unary part is the
    monotone sequence of pointers from these to children, and find() searches a child among their successors only. Each
    child has its count, quantised; words also have it exact.
    """

    @staticmethod
    def image(keys: np.ndarray, counts: np.ndarray, low_bits: int, exact: bool) -> bytes:
        codes = quantise(counts).astype("<u2").tobytes()
        return EliasFano.encode(keys, low_bits) + codes + (counts.astype("<u8").tobytes() if exact else b"")

    def __init__(self, raw):
        raw = np.frombuffer(raw, np.uint8) if not isinstance(raw, np.ndarray) else raw
        self.keys = EliasFano(raw)
        at, n = self.keys.size, self.keys.n
        self.codes = np.ndarray(n, "<u2", raw[at : at + 2 * n])
        rest = raw[at + 2 * n :]
        self.counts = np.ndarray(n, "<u8", rest) if len(rest) else None

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, by successor search among the children of its context; -1 if it isn't there."""
        child = keys & np.uint64((1 << self.keys.low_bits) - 1)
        context = (keys >> np.uint64(self.keys.low_bits)).astype(np.int64)
        lo, hi = self.keys.before(context), self.keys.before(context + 1)
        end = hi.copy()
        while len(open_ := np.flatnonzero(lo < hi)):
            middle = (lo[open_] + hi[open_]) // 2
            below = self.keys.low(middle) < child[open_]
            lo[open_[below]] = middle[below] + 1
            hi[open_[~below]] = middle[~below]
        found = np.full(len(keys), -1)
        inside = np.flatnonzero(lo < end)
        hit = inside[self.keys.low(lo[inside]) == child[inside]]
        found[hit] = lo[hit]
        return found

    def answers(self, keys: np.ndarray) -> tuple[bytes, bytes]:
        """Codes of the keys, and for words the exact counts, deflated."""
        at = self.find(keys)
        known = at >= 0
        codes, exact = np.full(len(at), _ABSENT), b""
        codes[known] = self.codes[at[known]]
        if self.counts is not None:
            counts = np.zeros(len(at), "<u8")
            counts[known] = self.counts[at[known]]
            exact = _deflated(counts)
        return zlib.compress(codes.astype("<u2").tobytes(), 1), exact


class Block:
    """Tokens of a block's documents in order, each document ended by the end token."""

    def __init__(self, row: dict):
        sizes = np.array(row["sizes"], np.int64)
        text = pa.decompress(row["packed"], int(sizes.sum()), codec="zstd") if sizes.sum() else b""
        at, tokens, counts = np.concatenate([[0], np.cumsum(sizes)]), [], []
        lo = 0
        while lo < len(sizes):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + tb.SLICE_BYTES, "right")) - 1)
            offsets = pa.py_buffer((at[lo : hi + 1] - at[lo]).astype(np.int64).tobytes())
            w = tb.Words(pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, offsets, pa.py_buffer(text)[int(at[lo]) : int(at[hi])]]), lower=True)
            tokens.append(np.insert(w.hashes(), w.first[1:], _END))
            counts.append(w.counts + 1)
            lo = hi
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.train = np.repeat(~np.array(row["held_out"], bool), self.counts)
        #: place of each token in its document
        self.place = np.arange(len(self.tokens)) - np.repeat(self.first[:-1], self.counts)
        self._hashes = [tb.mix64(self.tokens)]

    def hashes(self, order: int) -> np.ndarray:
        """Hash of the n-gram that ends at each token. Before a document stands one end token; where there are
        not enough tokens, the value means nothing."""
        while len(self._hashes) < order:
            shorter, k = self._hashes[-1], len(self._hashes)
            before = np.empty_like(shorter)
            before[1:] = shorter[:-1]
            if k == 1:
                before[self.place == 0] = tb.mix64(np.array([_END]))[0]
            self._hashes.append(tb.mix64(tb.mix64(self.tokens + np.uint64(k)) * _SPREAD + before))
        return self._hashes[order - 1]

    def keys(self, order: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens end an n-gram of that order, and its key: bits of the shard, of the context and of the child.

        The shard comes from the n-gram's own hash, so the children of a frequent context lie in all shards.
        """
        own = self.hashes(order)
        if order == 1:
            return np.arange(len(own)), own >> np.uint64(64 - WORD_BITS)
        which = np.flatnonzero(self.place >= order - 2)
        own = own[which]
        if order == 2:
            context = np.where(self.place == 0, tb.mix64(np.array([_END]))[0], np.roll(self.hashes(1), 1))
        else:
            context = self.hashes(order - 1)[which - 1]
        shard = (own >> np.uint64(64 - shard_bits)) << np.uint64(CONTEXT_BITS + CHILD_BITS) if shard_bits else np.uint64(0)
        return which, shard | ((context >> np.uint64(64 - CONTEXT_BITS)) << np.uint64(CHILD_BITS)) | (own & np.uint64((1 << CHILD_BITS) - 1))


def _inner_bits(order: int, shard_bits: int) -> int:
    """Bits of a key behind those of its shard."""
    return WORD_BITS - shard_bits if order == 1 else CONTEXT_BITS + CHILD_BITS


def _counted(block: Block, order: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block's n-grams of one order, sorted, and their counts in training texts."""
    which, keys = block.keys(order, shard_bits)
    # the lowest bit tells training tokens, so one sort gives distinct keys and their counts
    marked = np.sort((keys << np.uint64(1)) | block.train[which].astype(np.uint64))
    if not len(marked):
        return marked, np.zeros(0, "<u4")
    starts = np.flatnonzero(np.append(True, (marked[1:] >> np.uint64(1)) != (marked[:-1] >> np.uint64(1))))
    return marked[starts] >> np.uint64(1), np.add.reduceat(marked & np.uint64(1), starts).astype("<u4")


BLOCKS = "block long, doc_ids array<{kind}>, held_out array<boolean>, sizes array<long>, packed binary"


def packed_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents packed into blocks, one row each, in a written table: nothing is shuffled, and texts are packed once."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0
        codec = pa.Codec("zstd", compression_level=6)

        def packed():
            texts = [tb.column_bytes(x.column("text")) for x in held]
            sizes = np.concatenate([np.diff(at) for _, at in texts])
            lists = [pa.array([[v for x in held for v in x.column(c).to_pylist()]], pa.list_(held[0].schema.field(c).type)) for c in ("doc_id", "held_out")]
            raw = np.concatenate([raw for raw, _ in texts])
            blob = codec.compress(raw.tobytes(), asbytes=True) if len(raw) else b""
            return pa.RecordBatch.from_arrays([pa.array([(task << 32) | made], pa.int64()), *lists, pa.array([sizes], pa.list_(pa.int64())), pa.array([blob], pa.binary())], names=["block", "doc_ids", "held_out", "sizes", "packed"])

        for whole in batches:
            for batch in tb.slices(whole, most=max(1, min(block_bytes // 16, tb.SLICE_BYTES))):
                more = tb.column_bytes(batch.column("text"))[1][-1]
                if held and size + more > block_bytes:
                    yield packed()
                    held, size, made = [], 0, made + 1
                held.append(batch)
                size += more
        if held:
            yield packed()

    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False)).alias("held_out")
    return store.written(docs.select("doc_id", held, "text").mapInArrow(rows, BLOCKS.format(kind=kind)), "blocks")


def requests(blocks: DataFrame, order: int, shard_bits: int) -> DataFrame:
    """(n, shard, block, keys, counts): what each block asks of each shard: sorted keys, Elias-Fano coded, and its own counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block, out = Block(row), []
                for k in range(1, order + 1):
                    keys, counts = _counted(block, k, shard_bits)
                    cuts = np.searchsorted(keys >> np.uint64(_inner_bits(k, shard_bits)), np.arange((1 << shard_bits) + 1))
                    for s in np.flatnonzero(np.diff(cuts)).tolist():
                        lo, hi = cuts[s], cuts[s + 1]
                        inner = keys[lo:hi] & np.uint64((1 << _inner_bits(k, shard_bits)) - 1)
                        out.append((k, s, row["block"], EliasFano.encode(inner), _deflated(counts[lo:hi])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["n", "shard", "block", "keys", "counts"])

    return blocks.select("block", "held_out", "sizes", "packed").mapInArrow(rows, "n int, shard int, block long, keys binary, counts binary")


REPLIES = "n int, shard int, block long, codes binary, exact binary, image binary, tokens long, types long"


def _replies(n: int, shard: int, level: Level, blocks: list, asked: list[np.ndarray], first: tuple | None) -> pa.Table:
    rows = [first] if first else []
    rows += [(n, shard, name, *level.answers(keys), None, 0, 0) for name, keys in zip(blocks, asked)]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in REPLIES.split(", ")])


def _built(shard_bits: int):
    def rows(table: pa.Table) -> pa.Table:
        """The shard's image, from the counts of all blocks, and its answers to each block, read from the image."""
        n, shard = table.column("n")[0].as_py(), table.column("shard")[0].as_py()
        asked = [EliasFano(x.as_buffer()).decode() for x in table.column("keys")]
        counts = np.concatenate([_inflated(x.as_py(), "<u4") for x in table.column("counts")])
        keys, back = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(back, weights=counts).astype(np.int64)  # sums in doubles, exact up to 2^53
        del back, counts
        seen = total > 0
        keys, total = keys[seen], total[seen]
        image = Level.image(keys, total, _inner_bits(n, shard_bits) - POINTER_BITS, n == 1)
        whole = (int(total.sum()), len(total)) if n == 1 else (0, 0)
        return _replies(n, shard, Level(image), table.column("block").to_pylist(), asked, (n, shard, None, None, None, image, *whole))

    return rows


def _asked(key, requests: pa.Table, images: pa.Table) -> pa.Table:
    """A kept shard's answers to blocks of any texts."""
    asked = [EliasFano(x.as_buffer()).decode() for x in requests.column("keys")]
    level = Level(images.column("image")[0].as_py() if images.num_rows else EliasFano.encode(np.zeros(0, np.uint64), 1))
    if key[0].as_py() == 1 and level.counts is None:
        level.counts = np.zeros(0, "<u8")
    if not asked:
        return _replies(0, 0, level, [None], [np.zeros(0, np.uint64)], None).slice(0, 0)
    return _replies(key[0].as_py(), key[1].as_py(), level, requests.column("block").to_pylist(), asked, None)


@dataclass(frozen=True)
class Model:
    """A trie kept as a table: shards (n, shard, image, tokens, types) and what is needed to ask them."""

    shards: DataFrame
    order: int
    shard_bits: int
    tokens: int
    types: int

    def save(self, path: str) -> None:
        self.shards.withColumn("order", F.lit(self.order)).withColumn("shard_bits", F.lit(self.shard_bits)).write.option("compression", "zstd").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        found = spark.read.parquet(path)
        total = found.agg(F.sum("tokens"), F.sum("types"), F.max("order"), F.max("shard_bits")).first()
        return Model(found.drop("order", "shard_bits"), total[2], total[3], total[0], total[1])


def _of_order(replies: pa.Table, which: np.ndarray, k: int, column: str) -> np.ndarray:
    """A block's codes or exact counts of one order, over all shards in their order."""
    read, kind = (_inflated, "<u8") if column == "exact" else (lambda raw, kind: np.frombuffer(zlib.decompress(raw), kind), "<u2")
    parts = [read(x.as_py(), kind) for x in replies.column(column).filter(pa.array(which == k))]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _scored(order: int, shard_bits: int, n: int, v: int, concentration: dict[int, float]):
    def rows(table: pa.Table, replies: pa.Table) -> pa.Table:
        """Base columns and scores of a block's documents from the answers to its distinct keys, in key order."""
        out = {c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        replies = replies.sort_by([("n", "ascending"), ("shard", "ascending")])
        numbers = replies.column("n").to_numpy()
        for row in table.to_pylist():
            block = Block(row)
            counts, before = None, None
            for k in range(1, order + 1):
                which, keys = block.keys(k, shard_bits)
                back = np.unique(keys, return_inverse=True)[1]
                count = restored(_of_order(replies, numbers, k, "codes"))[back] if len(keys) else np.zeros(0)
                if k == 1:
                    counts = _of_order(replies, numbers, 1, "exact")[back] if len(keys) else np.zeros(0)
                    p = (count + 0.1) / (n + 0.1 * (v + 1))
                    # the context of a document's first word is the end token, the last token of every document
                    ends = count[block.first[1:] - 1]
                    before = np.roll(count, 1)
                    before[block.first[:-1]] = ends
                else:
                    m = concentration.get(k, 30.0)
                    p = p.copy()
                    p[which] = (count + m * p[which]) / (before[which] + m)
                    longer = np.zeros(len(p))
                    longer[which] = count
                    before = np.roll(longer, 1)
            out["doc_id"] += row["doc_ids"]
            out["held_out"] += row["held_out"]
            out["n_tokens"].append(block.counts)
            out["n_known"].append(tb.per_doc((counts > 0).astype(np.int64), block.first))
            out["base_score"].append(tb.per_doc(np.log10((counts + 0.1) / (n + 0.1 * (v + 1))), block.first))
            out["score"].append(tb.per_doc(np.log10(p), block.first))
        kinds = {"n_tokens": np.int64, "n_known": np.int64, "base_score": float, "score": float}
        columns = {c: np.concatenate(x).astype(kinds[c]) if x else np.zeros(0, kinds[c]) for c, x in out.items() if c in kinds}
        of = {"doc_id": pa.array(out["doc_id"], table.schema.field("doc_ids").type.value_type), "held_out": pa.array(out["held_out"], pa.bool_()), **{c: pa.array(x) for c, x in columns.items()}}
        of["train_tokens"] = pa.array(np.full(len(of["n_tokens"]), n, np.int64))
        return pa.table({c: of[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")})

    return rows


def _scores(blocks: DataFrame, replies: DataFrame, model: Model, concentration: dict[int, float]) -> DataFrame:
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    scored = _scored(model.order, model.shard_bits, model.tokens, model.types, concentration)
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(replies.select("n", "shard", "block", "codes", "exact").groupBy("block")).applyInArrow(scored, schema)


def shard_bits_for(total_bytes: int, shard_keys: int, block_bytes: int) -> int:
    """log2 of the number of shards: by the n-grams that blocks ask, but leaving MESSAGE_KEYS of a block's to each shard."""
    wanted = max(1, -(-(total_bytes // 6) // shard_keys))
    most = max(1, block_bytes // 6 // MESSAGE_KEYS)
    return (min(wanted, most) - 1).bit_length()


def train(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, shard_keys: int = SHARD_KEYS) -> tuple[Model, DataFrame, DataFrame]:
    """The model of docs (doc_id, text), their packed blocks, and the model's answers to these blocks; all written tables."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = shard_bits_for(total, shard_keys, block_bytes)
    blocks = packed_blocks(docs, block_bytes)
    made = store.written(requests(blocks, order, bits).groupBy("n", "shard").applyInArrow(_built(bits), REPLIES), "levels", drop_shuffles=True)
    shards = made.where("block is null").select("n", "shard", "image", "tokens", "types")
    size = shards.agg(F.sum("tokens"), F.sum("types")).first()
    return Model(shards, order, bits, size[0] or 0, size[1] or 0), blocks, made.where("block is not null")


def score(docs: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES, concentration: dict[int, float] = CONCENTRATION) -> DataFrame:
    """lm_scores of docs by a model that was trained, or saved and loaded, before; train_tokens are the model's."""
    blocks = packed_blocks(docs, block_bytes)
    asked = requests(blocks, model.order, model.shard_bits).groupBy("n", "shard")
    replies = asked.cogroup(model.shards.select("n", "shard", "image").groupBy("n", "shard")).applyInArrow(_asked, REPLIES)
    return _scores(blocks, replies, model, concentration)


def lm_scores(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, shard_keys: int = SHARD_KEYS, concentration: dict[int, float] = CONCENTRATION) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs (doc_id, text).

    The model of order n is learnt from all documents whose crc32(doc_id as text) mod 10 is not 0:
    p(w) = (c + 0.1) / (N + 0.1 (V + 1)); with a context h and its shorter h', p(w | h) = (c(hw) + m p(w | h')) /
    (c(h) + m), so every context's probabilities sum to one, unseen words included. Counts are read from the trie, quantised.

    Documents are packed into blocks. A block sends the sorted, distinct keys of its n-grams with
    their training counts, Elias-Fano coded, to shards by key range; a shard adds up the counts of all blocks,
    becomes a part of the trie, as bytes in a written table, and answers each block by searching these bytes. A block's
    message holds MESSAGE_KEYS n-grams on average at least, so what is exchanged follows the n-grams of the corpus. What
    a task holds depends on block_bytes and shard_keys (and the longest text); hot n-grams are one key for each block, and a
    frequent context's children lie in all shards. Keys are hashes: of 56 bits for words, else of 38 and the shard's.
    Null texts are empty and have the end token alone; a null doc_id is in training. Repeated rows
    count and score as often as they stand. Ties don't arise; other columns are not read.
    """
    model, blocks, replies = train(docs, order, block_bytes, shard_keys)
    return _scores(blocks, replies, model, concentration)
