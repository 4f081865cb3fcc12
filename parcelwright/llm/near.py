"""MinHash near-dedup: chosen-path similarity join over word shingles, and the components of its links."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelwright.llm import textbatch as tb
from parcelwright.sources import workspace as store

SHINGLE = 5
#: Minwise values that trees branch on, and those of which a sketch has a byte each.
COORDINATES = 64
SKETCH = 192
#: Independent trees; the first branching of tree t is by coordinate t.
TREES = 24
#: Nodes of at most this many documents are compared exhaustively; larger ones branch again.
NODE_LIMIT = 24
#: Minwise values that a node takes at each further branching; a tree is as deep as this list.
BRANCHES = (2, 3)
#: Equal sketch bytes below which a pair is not looked at: five standard deviations below 0.85 of SKETCH.
LEAST_EQUAL = 138
#: Shingles and sets in a group of a node that stays large; two groups meet in a tile, and all its pairs are compared.
TILE_SHINGLES = 400_000
TILE_SETS = 2048

_SALTS = [int(tb.seeded(1000 + c)) for c in range(SKETCH)]


def shingle_hashes(w: tb.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, row by row, and n+1 offsets; a row of fewer words has its whole sequence."""
    hashed = w.hashes()
    start, full = tb.windows(hashed, w.doc, SHINGLE)
    doc = w.doc[start]
    few = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    if len(few):
        short = np.array([tb.mix64(np.cumsum(hashed[w.first[d] : w.first[d + 1]] * np.uint64(3), dtype=np.uint64))[-1:] + np.uint64(w.counts[d]) for d in few], np.uint64).ravel()
        doc, full = np.append(doc, few), np.append(full, tb.mix64(short))
        order = np.argsort(doc, kind="stable")
        doc, full = doc[order], full[order]
    return full, np.searchsorted(doc, np.arange(w.n_docs + 1))


def minwise(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SKETCH minwise values of each row that has shingles, as uint32."""
    out = np.empty((len(first), SKETCH), np.uint32)
    for c, salt in enumerate(_SALTS):
        x = hashes * np.uint64(salt)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, c] = np.minimum.reduceat((x >> np.uint64(32)).astype(np.uint32), first)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, set_key (128-bit hash of the set; null without words), minwise, sketch."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole):
                w = tb.Words(batch.column("text"), lower=True)
                hashes, first = shingle_hashes(w)
                filled = np.flatnonzero(np.diff(first))
                keys, sizes = [None] * w.n_docs, np.zeros(w.n_docs, np.int64)
                for d in filled:
                    one = np.unique(hashes[first[d] : first[d + 1]])
                    sizes[d], keys[d] = len(one), hashlib.blake2b(one.tobytes(), digest_size=16).digest()
                values = np.zeros((w.n_docs, SKETCH), np.uint32)
                if len(filled):
                    values[filled] = minwise(hashes, first[filled])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.n_docs * COORDINATES + 1, COORDINATES, dtype=np.int32)), pa.array(values[:, :COORDINATES].view(np.int32).ravel()))
                low = values.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(sizes), pa.array(keys, pa.binary()), lists, pa.array([x.tobytes() for x in low], pa.binary())], names=["doc_id", "th", "n_shingles", "set_key", "minwise", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(rows, f"doc_id {kind}, th long, n_shingles long, set_key binary, minwise array<int>, sketch binary")


def _packed(batch: pa.RecordBatch, column: str) -> np.ndarray:
    raw, _ = tb.column_bytes(batch.column(column))
    return raw.reshape(batch.num_rows, -1)


def _node_pairs(labelled: bool):
    """Pairs worth verifying in small nodes that come sorted by node.

    Without labels: each member with the one most like it. With labels: all pairs of unequal labels.
    """

    def pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
        node = batch.column("node").to_numpy()
        sketch = _packed(batch, "sketch")
        label = np.array([hash(x) for x in batch.column("label").to_pylist()]) if labelled else None
        best, partner = np.full(len(node), LEAST_EQUAL - 1), np.zeros(len(node), np.int64)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(1, NODE_LIMIT):
            at = np.flatnonzero(node[k:] == node[:-k]) + k
            if not len(at):
                break
            if labelled:
                at = at[label[at] != label[at - k]]
            equal = (sketch[at] == sketch[at - k]).sum(axis=1)
            if labelled:
                at = at[equal >= LEAST_EQUAL]
                left.append(at - k)
                right.append(at)
            else:
                for one, other in ((at, at - k), (at - k, at)):
                    up = equal > best[one]
                    best[one[up]], partner[one[up]] = equal[up], other[up]
        if not labelled:
            right.append(np.flatnonzero(best >= LEAST_EQUAL))
            left.append(partner[right[-1]])
        keys = batch.column("set_key")
        return pa.RecordBatch.from_arrays([keys.take(pa.array(np.concatenate(x))) for x in (left, right)], names=["a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 20_000):
                part = batch.slice(lo, 20_000)
                if rest is not None and rest.num_rows:
                    part = pa.Table.from_batches([rest, part]).combine_chunks().to_batches()[0]
                node = part.column("node").to_numpy()
                whole = np.flatnonzero(node != node[-1])
                cut = int(whole[-1]) + 1 if len(whole) else 0
                if part.num_rows - cut > 40_000:  # a block of many sets, only without labels: neighbours in sketch order
                    cut = part.num_rows - NODE_LIMIT
                yield pairs(part.slice(0, min(cut + NODE_LIMIT, part.num_rows) if cut and node[cut - 1] == node[-1] else cut))
                rest = part.slice(cut)
        if rest is not None and rest.num_rows:
            yield pairs(rest)

    return rows


def _star_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = pa.array((_packed(batch, "sketch") == _packed(batch, "pivot_sketch")).sum(axis=1) >= LEAST_EQUAL)
        yield pa.RecordBatch.from_arrays([batch.column("pivot").filter(ok), batch.column("set_key").filter(ok)], names=["a", "b"])


def grow_trees(sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The leaves of all trees: (node, set_key, sketch, small), (pivot, set_key) pairs of large nodes, (node, set_key) of leaves still large.

    sets (set_key, minwise, sketch) has one row for each distinct set. A node's path hashes the tree and the
    minwise values chosen so far; a node of more than NODE_LIMIT sets branches by another coordinate that its
    path chooses, several at a time as BRANCHES says. Nodes of one set end there. What is still large
    at the end (sets that agree in half a dozen minwise values) is returned as it is, to be compared whole. It is
    also cut into blocks of sets next to each other in sketch order (not small), which only save work.
    """
    trees = F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.get("minwise", t).alias("v")) for t in range(TREES))))
    level = sets.select("set_key", trees.alias("x")).select("set_key", F.xxhash64("x.t", "x.v").alias("node"))
    small, stars = [], []
    over = level.limit(0)
    slim = sets.select("set_key", "minwise", "sketch")
    for depth in range(len(BRANCHES) + 1):
        counted = store.written(level.groupBy("node").agg(F.count("*").alias("members")).where("members > 1"), "counts")
        held = store.written(level.join(counted, "node"), "nodes")
        small.append(held.where(F.col("members") <= NODE_LIMIT).select("node", "set_key", F.lit(True).alias("small")))
        large = held.where(F.col("members") > NODE_LIMIT)
        if large.isEmpty():
            break
        pivots = store.written(large.groupBy("node").agg(F.min("set_key").alias("pivot")), "pivots")
        stars.append(large.join(pivots, "node").where("pivot <> set_key").select("pivot", "set_key"))
        if depth < len(BRANCHES):
            values = [F.get("minwise", F.pmod(F.xxhash64("node", F.lit(k)), F.lit(COORDINATES)).cast("int")) for k in range(BRANCHES[depth])]
            level = large.join(slim, "set_key").select("set_key", F.xxhash64("node", *values).alias("node"))
        else:
            place = F.conv(F.expr("substring(hex(sketch), cast(abs(xxhash64(node)) % 180 * 2 + 1 as int), 8)"), 16, 10).cast("double") / 2**32
            block = F.xxhash64("node", F.floor(place * F.ceil(F.col("members") * 2 / NODE_LIMIT)))
            small.append(large.join(slim, "set_key").select(block.alias("node"), "set_key", F.lit(False).alias("small")))
            over = large.select("node", "set_key")
    leaves = small[0]
    for more in small[1:]:
        leaves = leaves.unionByName(more)
    pairs = stars[0] if stars else leaves.select(F.col("set_key").alias("pivot"), "set_key").limit(0)
    for more in stars[1:]:
        pairs = pairs.unionByName(more)
    return leaves.join(slim.drop("minwise"), "set_key"), pairs.distinct(), over


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(set_key, packed): the deflated text of one document of each set in ids (set_key, doc_id, th)."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole):
                raw, at = tb.column_bytes(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array([zlib.compress(raw[lo:hi].tobytes(), 1) for lo, hi in zip(at, at[1:])], pa.binary())], names=["_d", "_t", "packed"])

    packed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(rows, f"_d {kind}, _t long, packed binary")
    met = packed.join(ids, F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_t") == F.col("th")))
    return met.groupBy("set_key").agg(F.min("packed").alias("packed"))


def _sets_of(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes(tb.Words(pa.array([zlib.decompress(x) for x in packed.to_pylist()], pa.binary()).cast(pa.large_string()), lower=True))


def _verified(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                (ha, fa), (hb, fb) = _sets_of(batch.column("pa")), _sets_of(batch.column("pb"))
                keep = []
                for i in range(batch.num_rows):
                    one, two = np.unique(ha[fa[i] : fa[i + 1]]), np.unique(hb[fb[i] : fb[i + 1]])
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    keep.append(100 * both >= percent * (len(one) + len(two) - both))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return rows


def links(candidates: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b) whose full shingle sets have the similarity."""
    first = candidates.join(texts.select(F.col("set_key").alias("a"), F.col("packed").alias("pa")), "a")
    both = first.join(texts.select(F.col("set_key").alias("b"), F.col("packed").alias("pb")), "b")
    return both.select("a", "b", "pa", "pb").mapInArrow(_verified(percent), "a binary, b binary")


def common_counts(row: np.ndarray, shingle: np.ndarray, n: int) -> np.ndarray:
    """How many shingles each two of n sets share; (row, shingle) are distinct. Shingles of many sets go through a product of matrices."""
    both = np.zeros((n, n), np.float32)
    _, number, held = np.unique(shingle, return_inverse=True, return_counts=True)
    order = np.argsort(number, kind="stable")
    row, held, number = row[order], held[number[order]], number[order]
    dense = held > max(1, n // 16)
    at, (_, column) = row[dense], np.unique(number[dense], return_inverse=True)
    width = max(1, 8_000_000 // n)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        held_by = np.zeros((n, min(width, int(column[-1]) + 1 - lo)), np.float32)
        held_by[at[a:b], column[a:b] - lo] = 1
        both += held_by @ held_by.T
    few = ~dense & (held > 1)
    at, number = row[few], number[few]
    for k in range(1, n // 16 + 1):
        met = np.flatnonzero(number[k:] == number[:-k])
        if not len(met):
            break
        np.add.at(both, (at[met], at[met + k]), 1)
        np.add.at(both, (at[met + k], at[met]), 1)
    return both


def linked(hashes: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets compared: the first of each component of their links, for each other member of it, and the member."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, row))
    row, shingle = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    row, shingle = row[new], shingle[new]
    size = np.bincount(row, minlength=n)
    both = common_counts(row, shingle, n)
    link = np.empty((n, n), bool)
    for lo in range(0, n, 256):
        part = both[lo : lo + 256].astype(np.int64)
        link[lo : lo + 256] = 100 * part >= percent * (size[lo : lo + 256, None] + size - part)
    seed = np.full(n, -1)
    for i in range(n):
        reached = np.array([i]) if seed[i] < 0 else []
        while len(reached):
            seed[reached] = i
            reached = np.flatnonzero(link[reached].any(axis=0) & (seed < 0))
    others = np.flatnonzero(seed != np.arange(n))
    return seed[others], others


def _tile_links(percent: int):
    """(a, b) of one component within a tile, for whole tiles that come sorted: at most one row for each set."""

    def joined(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = linked(*_sets_of(batch.column("packed")), percent)
        keys = batch.column("set_key")
        return pa.RecordBatch.from_arrays([keys.take(pa.array(a)), keys.take(pa.array(b))], names=["a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_tile, held = None, []
        for batch in batches:
            tile = batch.column("tile").to_numpy()
            edges = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if held and tile[lo] != open_tile:
                    yield joined(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held = []
                open_tile = tile[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield joined(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return rows


def tiles(over: DataFrame) -> DataFrame:
    """(tile, set_key) such that any two sets of a node with unequal labels meet in a tile of bounded size.

    over: node, set_key, n_shingles, label. The sets of a node's most frequent label need not meet each other. They
    and the rest are dealt into groups by hash; each group of the rest meets all groups. Nodes of one label have no tile.
    """
    of_label = over.groupBy("node", "label").agg(F.sum("n_shingles").alias("s"), F.count("*").alias("n"))
    most = F.struct("n", "label", "s")
    summed = of_label.groupBy("node").agg(F.max(most).alias("main"), F.sum("s").alias("s"), F.sum("n").alias("n")).where("n > main.n")
    groups = lambda s, n: F.ceil(F.greatest(s / TILE_SHINGLES, n / TILE_SETS)).cast("int")
    sized = summed.select("node", F.col("main.label").alias("main"), groups(F.col("main.s"), F.col("main.n")).alias("ga"), groups(F.col("s") - F.col("main.s"), F.col("n") - F.col("main.n")).alias("gb"))
    in_main = F.col("label") == F.col("main")
    dealt = over.join(sized, "node").withColumn("i", F.pmod(F.xxhash64("set_key", F.lit(7)), F.when(in_main, F.col("ga")).otherwise(F.col("gb"))).cast("int"))
    with_main = lambda a, b: F.xxhash64("node", F.lit(1), a, b)
    upto = lambda g: F.sequence(F.lit(0), F.col(g) - 1)
    among = F.transform(F.filter(upto("gb"), lambda j: j != F.col("i")), lambda j: F.xxhash64("node", F.lit(2), F.least("i", j), F.greatest("i", j)))
    met = F.when(in_main, F.transform(upto("gb"), lambda j: with_main(F.col("i"), j))).otherwise(F.concat(F.transform(upto("ga"), lambda j: with_main(j, F.col("i"))), among))
    return dealt.select(F.explode(met).alias("tile"), "set_key")


def components(edges: DataFrame) -> DataFrame:
    """(set_key, root) of all keys in edges (a, b): root is the least key reachable.

    Each round takes the least root among neighbours, then follows roots to their roots; edges
    inside a component are dropped, and each round is a written table.
    """
    both = store.written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = store.written(both.groupBy(F.col("a").alias("set_key")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "roots")
    while True:
        ends = both.join(roots.select(F.col("set_key").alias("a"), F.col("root").alias("ra")), "a").join(roots.select(F.col("set_key").alias("b"), F.col("root").alias("rb")), "b")
        cross = ends.where("ra <> rb").select("ra", "rb")
        if cross.isEmpty():
            return roots
        # a root that has a smaller root across an edge points there; chains of roots are then followed to the end
        hooks = store.written(cross.groupBy("ra").agg(F.min("rb").alias("rb")).where("rb < ra"), "hooks")
        while True:
            far = hooks.join(hooks.select(F.col("ra").alias("rb"), F.col("rb").alias("rc")), "rb", "left").select("ra", F.coalesce("rc", "rb").alias("rb"), F.col("rc").isNotNull().alias("moved"))
            far = store.written(far, "hooks")
            hooks = far.drop("moved")
            if far.where("moved").isEmpty():
                break
        roots = store.written(roots.join(hooks, roots["root"] == hooks["ra"], "left").select("set_key", F.coalesce("rb", "root").alias("root")), "roots")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, copies_of_set for every row of docs (doc_id, text).

    Equal sets fall together first, so a group of exact copies is one set. Trees are grown over the minwise
    values of distinct sets; star pairs of large nodes and best pairs of small ones are verified on full sets
    and give components; then all remaining pairs of small nodes that join two components are verified too.
    Of nodes that stay large, all pairs that could join two components are compared on full sets, tile by tile.
    A set's texts travel deflated, only for sets that are in a pair. Null and empty texts have no set and
    are linked with nothing. Rows of equal doc_id are told apart by their sets.
    """
    held = store.written(sketches(docs), "sketches")
    filled = held.where("set_key is not null")
    one = filled.groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th", "minwise", "sketch", "n_shingles")).alias("x"), F.count("*").alias("copies_of_set"))
    sets = store.written(one.select("set_key", "copies_of_set", "x.doc_id", "x.th", "x.minwise", "x.sketch", "x.n_shingles"), "sets")
    leaves, stars, over = grow_trees(sets.select("set_key", "minwise", "sketch"))
    dealt = store.written(leaves, "leaves")
    slim = sets.select("set_key", "sketch")
    starred = stars.join(slim, "set_key").join(slim.select(F.col("set_key").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot").select("pivot", "set_key", "sketch", "pivot_sketch")
    star_pairs = starred.mapInArrow(_star_pairs, "a binary, b binary")
    sorted_leaves = dealt.repartition("node").sortWithinPartitions("node", "sketch", "set_key")
    best = sorted_leaves.select("node", "set_key", "sketch").mapInArrow(_node_pairs(False), "a binary, b binary")
    ordered = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    candidates = store.written(star_pairs.unionByName(best).select(*ordered).distinct(), "candidates")
    # a set with any pair to verify in a small node has its best one among the candidates, so these are all the texts needed
    paired = candidates.select(F.explode(F.array("a", "b")).alias("set_key")).distinct()
    texts = store.written(_texts(docs, sets.select("set_key", "doc_id", "th").join(paired, "set_key")), "texts")
    found = store.written(links(candidates, texts, percent), "links")
    roots = components(found)
    labelled = dealt.where("small").join(roots, "set_key", "left").select("node", "set_key", "sketch", F.coalesce("root", "set_key").alias("label"))
    labelled = store.written(labelled, "labelled")
    mixed = labelled.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("node")
    more = labelled.join(mixed, "node").repartition("node").sortWithinPartitions("node", "sketch", "set_key").select("node", "set_key", "sketch", "label").mapInArrow(_node_pairs(True), "a binary, b binary").select(*ordered).distinct()
    rest = store.written(links(more.join(candidates, ["a", "b"], "left_anti"), texts, percent), "links")
    numbered = over.join(sets.select("set_key", "n_shingles"), "set_key").join(roots, "set_key", "left").select("node", "set_key", "n_shingles", F.coalesce("root", "set_key").alias("label"))
    tiled = store.written(tiles(store.written(numbered, "over")), "tiles")
    if not tiled.isEmpty():
        met = sets.select("set_key", "doc_id", "th").join(tiled.select("set_key").distinct(), "set_key")
        whole = tiled.join(store.written(_texts(docs, met), "texts"), "set_key").repartition("tile").sortWithinPartitions("tile", "set_key")
        rest = rest.unionByName(store.written(whole.select("tile", "set_key", "packed").mapInArrow(_tile_links(percent), "a binary, b binary").distinct(), "links"))
    if not rest.isEmpty():
        roots = components(found.unionByName(rest))
    named = sets.select("set_key", "doc_id", "copies_of_set").join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(least, "root").select("set_key", "component_id", "copies_of_set")
    out = held.drop("minwise", "sketch").join(of_set, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), F.coalesce("copies_of_set", F.lit(1)).alias("copies_of_set"), "th")


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """docs without near-duplicates: of each component the document with the least doc_id stays.

    Columns are those of docs, whatever their names. Rows of one doc_id and text stay or go together; rows without a
    doc_id, and null and empty texts, stay. An empty table gives an empty one; texts of any length are compared whole.
    """
    gone = near_duplicates(docs.select("doc_id", "text"), percent).where("not kept").select(F.col("doc_id").alias("_near_doc"), F.col("th").alias("_near_text"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return whole.join(gone, (F.col("_row.doc_id") == F.col("_near_doc")) & (F.xxhash64("_row.text") == F.col("_near_text")), "left_anti").select("_row.*")
