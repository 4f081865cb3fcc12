"""Words of Arrow string columns as numpy arrays: boundaries, owners and 64-bit hashes.

Work runs over slices of a record batch of a few megabytes each, whatever the batch holds, so a task's
memory follows the slice size and its longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

#: 256-entry tables by byte: True ends a word. Bytes of 0x80 and above belong to words in both.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
LOWER_BYTES = LOWER.tobytes()
#: For bytes.translate: lower-cases A-Z and blanks all that is no letter or digit.
FOLD_ALNUM = bytes(0x20 if NOT_ALNUM[i] else int(LOWER[i]) for i in range(256))

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on uint64 that spreads each bit over all (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int) -> np.uint64:
    """An odd multiplier drawn from seed."""
    return mix64(np.array([seed + 0x51ED27], np.uint64))[0] | np.uint64(1)


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def forget() -> None:
    """Drop the tables of powers, so that a driver that has used them doesn't send them with its tasks."""
    _powers.clear()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans get equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=total[1:])
    raw = (total[ends] - total[starts]) * _power(_BASE_INVERSE, len(data) + 1)[starts]
    return mix64(raw + mix64((ends - starts).astype(np.uint64)))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one uint8 array, and n+1 offsets into it; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `most` bytes of text each; no text is cut."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths) - lengths) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        yield batch.slice(lo, hi - lo)


class Words:
    """The words of a string column, in order.

    starts, ends: byte spans in `data`; doc: row of each word; first: n+1 offsets of rows into the words.
    """

    def __init__(self, column: pa.Array, separators: np.ndarray = BLANK, lower: bool = False):
        raw, self.at = column_bytes(column)
        self.data = LOWER[raw] if lower else raw
        self.n_docs = len(column)
        word = ~separators[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.at] = True
        before = np.empty(len(raw), bool)
        after = np.empty(len(raw), bool)
        if len(raw):
            before[0] = after[-1] = False
            before[1:] = word[:-1]
            after[:-1] = word[1:]
        self.starts = np.flatnonzero(word & ~(before & ~edge[:-1]))
        self.ends = np.flatnonzero(word & ~(after & ~edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.at)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def token(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over each row's stretch; rows without any get 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each run of `width` words that stays in one row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.flatnonzero(doc[:n] == doc[width - 1 :])
    out = np.zeros(len(start), np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + hashes[start + k]
    return start, mix64(out)
