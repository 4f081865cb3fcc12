"""Line dedup: content-defined chunks of lines, removed where their bytes stood before.

A hash rolls over the hashes of two consecutive lines. In each of FAMILIES families a bit of it, set for half of all pairs, makes the
pair's first line begin chunks and its second line end them, so a boundary depends on lines inside a chunk alone and shifts with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelwright.sources import workspace as store

#: A chunk of several lines counts with this many words; a single line only as a passage of PASSAGE_WORDS.
CHUNK_WORDS = 12
PASSAGE_WORDS = 50


#: Families of boundaries, each a bit of the rolling hash: what one family cuts badly, another cuts well.
FAMILIES = 8
#: A chunk that counts ends at its family's next boundary, after this many further lines at the latest.
REACH = 3

#: A span is kept as one long: start times this, plus the number of lines.
_SPAN = 1 << 31


def _words(line: Column) -> Column:
    return F.regexp_count(line, F.lit(r"[^ \t-\r]+"))


def _least(counts: Column) -> Column:
    """How many of the first lines make a chunk that counts: two or more, with CHUNK_WORDS; 0 if none do."""
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("n"))
    full = lambda a: (a["n"] > 1) & (a["s"] >= CHUNK_WORDS)
    met = F.aggregate(counts, start, lambda a, c: F.when(full(a), a).otherwise(F.struct((a["s"] + c).alias("s"), (a["n"] + 1).alias("n"))))
    return F.when(full(met), met["n"]).otherwise(0)


def _shortest(c0: Column, c1: Column, c2: Column, rest: Column) -> Column:
    """_least, with the first three lines tried by themselves: they suffice for most."""
    return F.when(c0 + c1 >= CHUNK_WORDS, 2).when(c0 + c1 + c2 >= CHUNK_WORDS, 3).otherwise(_least(rest))


def _cuts(begin: Column, met: list[Column]) -> list[Column]:
    """Where the families that begin in a line end: for each of the lines met, whether one of them ends there. begin and met are
    bits by family; whoever met no boundary before the last line ends there."""
    out, seen = [], F.lit(0)
    for x in met[:-1]:
        left = begin.bitwiseAND(F.bitwise_not(seen))
        out.append(left.bitwiseAND(x) != 0)
        seen = seen.bitwiseOR(x)
    return [*out, begin.bitwiseAND(F.bitwise_not(seen)) != 0]


def _spans() -> Column:
    """The chunks that count, from boundary to boundary in each family; long lines by themselves.

    Chunks begin and end with lines that have words; `counts` has these lines' words, `at` their places, and `marks` the families
    in which a line and the next are a boundary; blank lines between lines of a chunk belong to it. A family's chunk goes from a
    beginning to the first ending that makes it count, and likewise back from an ending; REACH bounds both.
    """
    n = F.size("counts")
    lines = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    count = lambda i: F.get("counts", i)
    mark = lambda i: F.when(i >= 0, F.coalesce(F.get("marks", i), F.lit(0))).otherwise(0)
    span = lambda i, j: F.when((i >= 0) & (j < n), F.get("at", i).cast("long") * _SPAN + F.get("at", j) - F.get("at", i) + 1)
    onward = F.transform(lines, lambda i: _shortest(count(i), count(i + 1), count(i + 2), F.slice("counts", i + 1, F.lit(CHUNK_WORDS))))
    back = F.transform(lines, lambda i: F.when(i > 0, _shortest(count(i), count(i - 1), F.when(i > 1, count(i - 2)), F.reverse(F.slice("counts", F.greatest(i + 2 - CHUNK_WORDS, F.lit(1)), F.least(i + 1, F.lit(CHUNK_WORDS)))))).otherwise(0))
    steps = range(REACH + 1)

    def from_begin(k: Column, i: Column) -> Column:
        cuts = _cuts(mark(i), [mark(i + k - 2 + d) for d in steps])
        return F.when((k > 0) & (mark(i) != 0), F.array(*(F.when(c, span(i, i + k - 1 + d)) for d, c in zip(steps, cuts))))

    def from_end(k: Column, j: Column) -> Column:
        cuts = _cuts(mark(j - 1), [mark(j - k + 1 - d) for d in steps])
        return F.when((k > 0) & (mark(j - 1) != 0), F.array(*(F.when(c, span(j - k + 1 - d, j)) for d, c in zip(steps, cuts))))

    alone = F.transform(F.filter(lines, lambda i: count(i) >= PASSAGE_WORDS), lambda i: span(i, i))
    drawn = F.concat(F.transform(onward, from_begin), F.transform(back, from_end))
    both = F.concat(F.flatten(F.filter(drawn, lambda x: x.isNotNull())), alone)
    return F.array_distinct(F.filter(both, lambda s: s.isNotNull()))


def _start(span: Column) -> Column:
    return F.shiftright(span, 31).cast("int")


def _length(span: Column) -> Column:
    return span.bitwiseAND(_SPAN - 1).cast("int")


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, th, start, n, chunk): the content-defined chunks that count, with the hash of their line hashes; one scan, narrow rows."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("th"), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    base = lines.select("doc_id", "th", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"), F.transform("lines", _words).alias("words"))
    filled = F.filter(F.transform("words", lambda c, i: F.when(c > 0, i)), lambda i: i.isNotNull())
    base = base.select("doc_id", "th", "hashes", F.filter("words", lambda c: c > 0).alias("counts"), filled.alias("at"))
    rolled = F.transform("at", lambda i, k: F.xxhash64(F.get("hashes", i), F.get("hashes", F.get("at", k + 1))))
    marks = F.transform(F.slice(rolled, F.lit(1), F.greatest(F.size("at") - 1, F.lit(0))), lambda h: h.bitwiseAND((1 << FAMILIES) - 1).cast("int"))
    base = base.select("*", marks.alias("marks"))
    spans = base.select("doc_id", "th", "hashes", _spans().alias("spans"))
    hashed = lambda s: F.struct(_start(s).alias("start"), _length(s).alias("n"), F.xxhash64(F.slice("hashes", _start(s) + 1, _length(s)), _length(s)).alias("chunk"))
    # explode_outer, for explode would let the optimizer move a copy of all this into a filter, hashes inside the loop over spans
    return spans.select("doc_id", "th", F.explode_outer(F.transform("spans", hashed)).alias("c")).select("doc_id", "th", "c.*").where("chunk is not null")


def _key(doc_id: str = "doc_id", th: str = "th") -> Column:
    return F.struct(F.col(doc_id).alias("d"), F.col(th).alias("t"), F.col("start").alias("s"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, th, start, n) of chunks whose bytes stand earlier: at a smaller (doc_id, th, start).

    th is a hash of the whole text: rows of one doc_id and text count as one document. Only spans and hashes
    are shuffled for all documents, and counted with partial sums, so a chunk of a third of all rows costs
    one row for each task. Bytes are cut out for the hashes found more than once and grouped: a
    hash that stands for two different byte strings is no repeat, and its chunks stay.
    """
    found = store.written(chunks(docs), "chunks")
    twice = store.written(found.groupBy("chunk").agg(F.count("*").alias("k")).where("k > 1").select("chunk"), "twice")
    again = store.written(found.join(twice, "chunk"), "again")

    held = again.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "n", "chunk")).alias("spans"))
    texts = docs.select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_t"), "text")
    cut = texts.join(held, F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_t") == F.col("th"))).select(F.split("text", "\n", -1).alias("lines"), "spans")
    cut = cut.select(F.explode_outer(F.transform("spans", lambda c: F.struct(c["chunk"].alias("chunk"), F.array_join(F.slice("lines", c["start"] + 1, c["n"]), "\n").alias("bytes")))).alias("c"))
    strings = cut.groupBy("c.chunk", "c.bytes").agg(F.lit(1).alias("one"))
    proven = strings.groupBy("chunk").agg(F.sum("one").alias("k")).where("k = 1").select("chunk")
    first = store.written(again.groupBy("chunk").agg(F.min(_key()).alias("first")).join(proven, "chunk"), "first")
    # of lines that repeat themselves, what overlaps the first occurrence stays with it
    overlap = F.col("first.d").eqNullSafe(F.col("doc_id")) & F.col("first.t").eqNullSafe(F.col("th")) & (F.col("start") < F.col("first.s") + F.col("n"))
    return again.join(first, "chunk").where(~overlap).select("doc_id", "th", "start", "n")


def _gone(docs: DataFrame) -> DataFrame:
    return repeated_chunks(docs).groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(F.collect_set(F.struct("start", "n")).alias("_gone"))


def _places(gone: str = "_gone") -> Column:
    """The distinct places of lines inside removed spans, by a hash set: linear in lines and spans."""
    return F.array_distinct(F.flatten(F.transform(gone, lambda g: F.sequence(g["start"], g["start"] + g["n"] - 1))))


def _others(lines: str) -> Column:
    """The places of the lines that stay."""
    return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), _places())


def _at(places: Column, values: str) -> Column:
    return F.transform(places, lambda i: F.get(values, i))


def line_report(docs: DataFrame) -> DataFrame:
    """What dedup_lines takes from each document, without the texts: doc_id, n_lines, n_words, n_removed, removed_words.

    A row for each row of docs; rows of one doc_id and text report alike, null doc_ids are one document each by text. A null or empty text is
    one empty line. Which occurrence is first, and texts of any length, are as in dedup_lines; other columns are not read;
    an empty table gives an empty one.
    """
    counts = docs.select("doc_id", F.xxhash64("text").alias("th"), F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), _words).alias("counts"))
    met = counts.join(_gone(docs), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
    taken = F.when(F.col("_gone").isNull(), F.array().cast("array<int>")).otherwise(_at(_places(), "counts"))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x).cast("long")
    return met.select("doc_id", F.size("counts").cast("long").alias("n_lines"), total("counts").alias("n_words"), F.size(taken).cast("long").alias("n_removed"), total(taken).alias("removed_words"))


def _cleaned(docs: DataFrame) -> DataFrame:
    """docs as the struct _row, with the new text and the array of lines taken out."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    met = whole.join(_gone(docs), F.col("_row.doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("_row.text") == F.col("_t")), "left")
    met = met.select("_row", "_gone", F.when(F.col("_gone").isNotNull(), F.split("_row.text", "\n", -1)).alias("_lines"))
    left = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(F.array_join(_at(_others("_lines"), "_lines"), "\n"))
    taken = F.when(F.col("_gone").isNull(), F.array().cast("array<string>")).otherwise(_at(_places(), "_lines"))
    return met.select("_row", left.alias("_text"), taken.alias("_taken"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with the lines of repeated chunks taken from their texts; adds n_lines, n_removed and removed_words.

    A chunk of several lines with CHUNK_WORDS, or a single line of PASSAGE_WORDS, is removed where its bytes
    occur in an earlier document or place; its first occurrence stays. Columns of these three names are replaced.
    Texts without a repeated chunk come through unchanged, and null stays null with one empty line.
    Words are runs of non-blanks, so indentation has no weight and a blank line adds nothing.
    Rows of one doc_id and text are one document: they keep or lose the same lines. Null doc_ids are
    one document each by text; an empty table gives an empty one. Which occurrence is first is decided by doc_id, then
    the hash of the text, then the place. Long texts are arrays of lines in one row, never gathered from others.
    """
    added = {
        "n_lines": F.size(F.split(F.coalesce("_row.text", F.lit("")), "\n", -1)).cast("long"),
        "n_removed": F.size("_taken").cast("long"),
        "removed_words": F.aggregate("_taken", F.lit(0), lambda a, x: a + _words(x)).cast("long"),
    }
    kept = [F.col("_text").alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c not in added]
    return _cleaned(docs).select(*kept, *(x.alias(k) for k, x in added.items()))


def keep_first_lines(docs: DataFrame) -> DataFrame:
    """dedup_lines with the columns of docs only, and without documents that lost all their words."""
    kept = _cleaned(docs).where((F.size("_taken") == 0) | (_words(F.col("_text")) > 0))
    return kept.select(*(F.col("_text").alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))
