"""URL filters: all glob rules at once in a bit-parallel Shift-And automaton."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelwright.llm import textbatch as tb

#: Fixed values: (verdict, host, path) rules; each fits its host, all subdomains, and paths that begin with its own.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Globs that block where no rule fits; * stays inside a host or path segment, ** runs over all.
BLOCK_GLOBS = ("**spam**", "**casino**", "**porn**", "**viagra**", "*.zip/**")


class ShiftAnd:
    """Glob patterns packed end to end into 64-bit words, one bit a literal.

    Bit i is set after a byte if that byte matched literal i and all before it. A star before a literal
    lets the bit before it stay set over the bytes that the star may cover; a literal without one takes
    its bit from the place before. A pattern's end has a bit of its own, tested after the last byte.
    """

    def __init__(self, patterns: list[str]):
        self.patterns = patterns
        bits: list[tuple[int | None, int]] = []  # (byte that enters this place, bytes that may stay: 0 none, 1 all but /, 2 all)
        self.first, self.last = [], []
        for pattern in patterns:
            raw, i = pattern.encode(), 0
            self.first.append(len(bits))
            bits.append((None, 0))  # the start
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    bits[-1] = (bits[-1][0], 2)
                    i += 2
                elif raw[i : i + 1] == b"*":
                    bits[-1] = (bits[-1][0], max(bits[-1][1], 1))
                    i += 1
                else:
                    bits.append((raw[i], 0))
                    i += 1
            self.last.append(len(bits) - 1)
        self.n_words = -(-len(bits) // 64) or 1

        def mask(places) -> np.ndarray:
            out = np.zeros(self.n_words, np.uint64)
            for p in places:
                out[p // 64] |= np.uint64(1) << np.uint64(p % 64)
            return out

        self.enter = np.stack([mask([p for p, (b, _) in enumerate(bits) if b == byte]) for byte in range(256)])
        self.stay = np.stack([mask([p for p, (_, s) in enumerate(bits) if s == 2 or s == 1 and byte != 0x2F]) for byte in range(256)])
        self.start = mask(self.first)

    def matches(self, column: pa.Array) -> np.ndarray:
        """A row of flags for each text: which patterns match it whole. All texts advance together, longest first."""
        data, at = tb.column_bytes(column)
        lengths = np.diff(at)
        order = np.argsort(-lengths, kind="stable")
        state = np.tile(self.start, (len(lengths), 1))
        active = len(order)
        starts, sizes = at[:-1][order], lengths[order]
        for step in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[active - 1] <= step:
                active -= 1
            byte = data[starts[:active] + step]
            now = state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.enter[byte]) | (now & self.stay[byte])
        out = np.empty((len(lengths), len(self.patterns)), bool)
        for k, p in enumerate(self.last):
            out[order, k] = (state[:, p // 64] >> np.uint64(p % 64)) & np.uint64(1)
        return out


def filter_urls(pages: DataFrame, rules: tuple = RULES, block_globs: tuple = BLOCK_GLOBS) -> DataFrame:
    """pages (page_id, url) with host, path, the longest rule that fits (host + path of the rule) and the verdict.

    A narrow scan without shuffle. Where no rule fits, a url that matches one of block_globs is blocked and
    any other allowed. A null url, or one without ://, has an empty host and path, fits no rule and is
    allowed. Of two rules of one length the earlier wins. Repeated rows give repeated rows. Urls of any length are read whole,
    a byte at a time for all urls of a slice; other columns are not read; an empty table gives an empty one.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    globs = [g for _, host, path in ranked for g in (f"{host}{path}**", f"*.{host}{path}**")] + list(block_globs)
    automaton = ShiftAnd(globs)
    names = [h + p for _, h, p in ranked]
    verdicts = [v for v, _, _ in ranked]
    n = len(ranked)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole, "canonical"):
                hit = automaton.matches(batch.column("canonical"))
                fits = hit[:, 0 : 2 * n : 2] | hit[:, 1 : 2 * n : 2]
                any_fit = fits.any(axis=1)
                which = fits.argmax(axis=1) if n else np.zeros(len(fits), int)
                blocked = hit[:, 2 * n :].any(axis=1)
                rule = [names[k] if f else None for f, k in zip(any_fit, which)]
                verdict = [verdicts[k] if f else ("block" if b else "allow") for f, k, b in zip(any_fit, which, blocked)]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    kind = dict(pages.dtypes)["page_id"]
    parts = (
        pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
        .withColumn("bare", F.regexp_extract("rest", r"(?s)^([^?#]*)", 1))
        .withColumn("raw_host", F.regexp_extract("bare", r"(?s)^([^/]*)", 1))
        .select("page_id", F.translate("raw_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"), F.expr("substring(bare, length(raw_host) + 1)").alias("path"))
        .withColumn("canonical", F.concat("host", "path"))
    )
    return parts.mapInArrow(rows, f"page_id {kind}, host string, path string, rule string, verdict string")
