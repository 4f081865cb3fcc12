"""Benchmark decontamination: a hash set of benchmark word windows against every document window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelwright.sources import workspace as store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of ASCII characters that are neither letters nor digits.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same class for texts whose case was kept.
RAW_GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
#: Sets of at most this many window hashes (8 bytes), or of documents that hold some (two numbers), are sent to every executor.
BROADCAST_ROWS = 2_000_000
#: log2 of the flags for window hashes that scans test before anything is exploded, at most.
MOST_BITS = 20


def words(text: Column) -> Column:
    """Lower-cased words of a text; an empty array for null."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, GAPS), lambda w: w != "")


def _slot(window: Column, bits: int) -> Column:
    """The place of a hash in a table of 2^bits flags."""
    return F.shiftrightunsigned(window, 64 - bits).cast("int")


def window_flags(hashes: DataFrame, bits: int) -> Column:
    """Flags of the slots of window hashes, 64 to a number, as a constant array: plans hold it many times over."""
    slot = _slot(F.col("_known"), bits)
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63))
    numbers = ["0"] * (1 << bits - 6)
    for r in hashes.groupBy(F.shiftright(slot, 6).alias("i")).agg(F.bit_or(flag).alias("x")).collect():  # at most 2^bits / 64 rows
        numbers[r.i] = str(r.x)
    return F.split(F.lit(",".join(numbers)), ",").cast("array<bigint>")  # folded into a constant


def _flagged(window: Column, flags: Column, bits: int) -> Column:
    """Whether the slot of a hash has its flag. The array of one is there to hash a window once."""
    return F.exists(F.array(window), lambda h: F.getbit(F.get(flags, _slot(h, bits - 6)), _slot(h, bits).bitwiseAND(63)) == 1)


def hashed_windows(rows: DataFrame, widths: list[int], keep: list[str], flags: Column | None = None, bits: int = 0) -> DataFrame:
    """rows with `windows`: for each width, the struct (window, w, at) of every run of that many words in `ws`; with
    flags, of those in a slot that has one.

    Words are hashed once, and windows are hashes of their words' hashes and the width. To be exploded by explode_outer
    only: explode would let the optimizer move a copy of all this into a filter, word hashes inside the loop over windows.
    """
    held = rows.select(*keep, F.size("ws").alias("_n"), F.transform("ws", lambda w: F.xxhash64(w)).alias("_h"))

    def windows(w: int) -> Column:
        window = lambda i: F.xxhash64(F.slice("_h", i, w), F.lit(w))
        starts = F.when(F.col("_n") >= w, F.sequence(F.lit(1), F.col("_n") - (w - 1))).otherwise(F.array().cast("array<int>"))
        if flags is not None:
            starts = F.filter(starts, lambda i: _flagged(window(i), flags, bits))
        return F.transform(starts, lambda i: F.struct(window(i).alias("window"), F.lit(w).alias("w"), (i - 1).alias("at")))

    return held.select(*keep, F.concat(F.array().cast("array<struct<window:bigint,w:int,at:int>>"), *map(windows, widths)).alias("windows"))


def benchmark_windows(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """(window, w, phrase, item): each window of each item, once.

    An item with fewer words than width, but not none, is one window of its own width.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    full = hashed_windows(items.where(F.size("ws") >= width), [width], ["item", "ws"])
    few = hashed_windows(items.where(F.size("ws") < width), list(range(1, width)), ["item", "ws"])
    few = few.withColumn("windows", F.filter("windows", lambda x: x["w"] == F.size("ws")))
    spread = full.unionByName(few).select("item", "ws", F.explode_outer("windows").alias("x"))
    return spread.select("x.window", "x.w", F.array_join(F.slice("ws", F.col("x.at") + 1, F.col("x.w")), " ").alias("phrase"), "item").where("window is not null").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits.

    hits lists (start, width) of each occurrence of a benchmark window, start counted from 0. A scan turns each
    document's windows into hashes; those that flags of the benchmark's hashes let pass become narrow rows (window hash,
    place) that meet the set of these hashes, sent to all executors. Beyond `broadcast_rows` hashes of 8 bytes, all rows are
    shuffled to a larger table. What is met is few: these documents are read
    again, and their words are compared with the windows' own, then joined with the items. Null and empty texts
    have no words. Rows of equal doc_id and text count as one document and give one row each. A table without
    items marks nothing; an item without an id marks words, and is not among the items counted. A long text is an array of
    hashes in one row; work is linear in it. Only doc_id and text are read, so other columns may have any name.
    """
    table = store.written(benchmark_windows(benchmark, width), "windows")
    sizes = sorted((r.w, r.n) for r in table.groupBy("w").agg(F.count_distinct("window").alias("n")).collect())  # at most `width` rows
    hashes = table.select(F.col("window").alias("_known")).distinct()
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("ws"))
    widths = [w for w, _ in sizes]
    n = sum(n for _, n in sizes)
    if n <= broadcast_rows:
        # one scan gives a marker row of each document, and its windows whose flag is set
        bits = min(MOST_BITS, max(10, n.bit_length() + 5))
        marker = F.array(F.struct(F.lit(None).cast("long").alias("window"), F.size("ws").alias("w"), F.lit(-1).alias("at")))
        spread = hashed_windows(rows.select("doc_id", "th", "ws", marker.alias("marker")), widths, ["doc_id", "th", "marker"], window_flags(hashes, bits), bits)
        narrow = spread.select("doc_id", "th", F.explode_outer(F.concat("marker", "windows")).alias("x")).select("doc_id", "th", "x.*")
        met = narrow.join(F.broadcast(hashes), narrow["window"] == F.col("_known"), "left").where((F.col("at") < 0) | F.col("_known").isNotNull()).drop("_known")
    else:
        narrow = hashed_windows(rows, widths, ["doc_id", "th"]).select("doc_id", "th", F.explode_outer("windows").alias("x")).select("doc_id", "th", "x.*")
        met = narrow.join(hashes, narrow["window"] == F.col("_known"), "left_semi")
        met = rows.select("doc_id", "th", F.lit(None).cast("long").alias("window"), F.size("ws").alias("w"), F.lit(-1).alias("at")).unionByName(met)
    met = store.written(met, "met")
    of_doc = met.where("at < 0").groupBy("doc_id", "th").agg(F.max("w").cast("long").alias("n_words"), F.count("*").alias("copies"))
    held = met.where("at >= 0").groupBy("doc_id", "th").agg(F.collect_set(F.struct("window", "w", "at")).alias("x"))
    some = store.written(met.where("at >= 0").select(F.col("doc_id").alias("_s"), F.col("th").alias("_u")).distinct(), "some")
    texts = docs.select(F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_t"), "text")
    if some.count() <= broadcast_rows:
        texts = texts.join(F.broadcast(some), F.col("_d").eqNullSafe(F.col("_s")) & (F.col("_t") == F.col("_u")), "left_semi")
    texts = texts.select("_d", "_t", words(F.col("text")).alias("ws"))
    again = texts.join(held, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")))
    phrased = F.transform("x", lambda x: F.struct(x["window"].alias("window"), x["w"].alias("w"), x["at"].alias("at"), F.array_join(F.slice("ws", x["at"] + 1, x["w"]), " ").alias("phrase")))
    cut = again.select("doc_id", "th", F.explode_outer(phrased).alias("x")).select("doc_id", "th", "x.*").distinct()
    proven = store.written(cut.join(table.select("window", "w", "phrase").distinct(), ["window", "w", "phrase"]), "hits")
    ids = proven.select("doc_id", "th", "window", "w", "phrase").distinct().join(table, ["window", "w", "phrase"]).groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    hits = proven.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct(F.col("at").alias("start"), F.col("w").alias("width")))).alias("hits"))
    key = lambda df, name: df.select(F.col("doc_id").alias(f"{name}_d"), F.col("th").alias(f"{name}_t"), name)
    same = lambda name: F.col("doc_id").eqNullSafe(F.col(f"{name}_d")) & (F.col("th") == F.col(f"{name}_t"))
    none_hit, none_id = F.array().cast("array<struct<start:int,width:int>>"), F.array().cast("array<string>")
    grouped = of_doc.join(key(hits, "hits"), same("hits"), "left").join(key(ids, "ids"), same("ids"), "left")
    grouped = grouped.select("doc_id", "th", "n_words", "copies", F.coalesce("hits", none_hit).alias("hits"), F.coalesce("ids", none_id).alias("ids"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def cover(acc, hit):
        end = hit["start"] + hit["width"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(end - F.greatest(acc["end"], hit["start"]), F.lit(0))).alias("n"))

    out = grouped.withColumn("n_hit", F.aggregate("hits", zero, cover)["n"].cast("long"))
    out = out.select("doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "hits", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_c"), "th")
    return out.drop("_c")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, spans: bool = False) -> DataFrame:
    """docs without the documents that hold a benchmark window or, with spans, with those words cut from their texts.

    Cutting puts one blank for each run of hit words and what stands between them. Columns stay as they are, whatever
    their names; rows of documents without a hit come through unchanged. Rows of equal doc_id and text stay or go
    together; null and empty texts, and all rows if the benchmark is empty, stay. Texts of any length are judged whole.
    """
    bad = contamination(docs.select("doc_id", "text"), benchmark, width).where("contaminated")
    marks = bad.select(F.col("doc_id").alias("_hit_doc"), F.col("th").alias("_hit_text"), F.col("hits").alias("_hits")).dropDuplicates(["_hit_doc", "_hit_text"])
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    key = F.col("_row.doc_id").eqNullSafe(F.col("_hit_doc")) & (F.xxhash64("_row.text") == F.col("_hit_text"))
    if not spans:
        gone = store.written(marks.drop("_hits"), "gone")
        return whole.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, key, "left_anti").select("_row.*")
    got = whole.join(marks, key, "left")
    pieces = F.regexp_extract_all("_row.text", F.lit(f"[{RAW_GAP}]*[^{RAW_GAP}]+"), F.lit(0))
    tail = F.regexp_extract("_row.text", rf"([{RAW_GAP}]*)\z", 1)
    places = F.array_distinct(F.flatten(F.transform("_hits", lambda h: F.sequence(h["start"], h["start"] + h["width"] - 1))))
    got = got.select("_row", "_hits", F.when(F.col("_hits").isNotNull(), pieces).alias("_pieces"), F.when(F.col("_hits").isNotNull(), tail).alias("_tail"), F.array_sort(places).alias("_places"))
    # a run of hit words leaves one blank, at its last word
    blanks = F.array_except(F.col("_places"), F.transform("_places", lambda i: i - 1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_pieces") - 1), F.col("_places"))
    parts = F.array_sort(F.concat(F.transform(stay, lambda i: F.struct(i.alias("i"), F.get("_pieces", i).alias("p"))), F.transform(blanks, lambda i: F.struct(i.alias("i"), F.lit(" ").alias("p")))))
    cut = F.concat(F.array_join(F.transform(parts, lambda x: x["p"]), ""), F.col("_tail"))
    return got.select(*(F.when(F.col("_hits").isNotNull(), cut).otherwise(F.col("_row.text")).alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))
