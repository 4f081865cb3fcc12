"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from parcelwright.sources import workspace as store

#: Rows of one source that share a key bucket, about.
BUCKET_ROWS = 2_000
#: Weights are counted in steps of one over this.
WEIGHT_STEPS = 20
NO_SOURCE = "\U0010ffff\U0010ffff"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.1 to 1.1: 0.1 and the share of characters that are neither digits nor symbols."""
    plain = F.length(F.translate(text, "#*$%&|<>0123456789", ""))
    return F.coalesce(F.lit(0.1) + plain / F.greatest(F.length(text), F.lit(1)), F.lit(0.1))


def exponential_key(doc_id: Column, text: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight with u in (0, 1) from an md5 of seed and doc_id (of the text where there is none): small keys are drawn first."""
    name = F.coalesce(doc_id.cast("string"), F.md5(text.cast("binary")), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.ln(u) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Targets of sources (source_key, source_size), one row each.

    Sources in code-point order weigh `weights`, repeating. All sizes are shared out by weight; no target
    exceeds `most` times its source's size, and what that leaves over is shared by weight among the rest.
    The sources that are capped are a prefix of the order by size over weight, so running sums find
    them without iteration. Both windows run over one row for each source, never over documents.
    """
    order = W.orderBy("source_key")
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    ratio = W.orderBy(F.col("source_size") / F.col("w"), "source_key")
    before = ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    cap = F.col("source_size") * most
    open_share = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("open", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("capped", cap * F.col("open") < F.col("left") * F.col("w"))
    )
    shared = (
        open_share.withColumn("spent", F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(everything), F.lit(0)))
        .withColumn("kept_w", F.coalesce(F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything), F.lit(0)))
    )
    share = F.col("w") * (F.col("total") - F.col("spent")) / F.greatest(F.col("kept_w"), F.lit(1))
    return shared.select("source_key", "source_size", F.when(F.col("capped"), cap.cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, bucket_rows: int = BUCKET_ROWS, whole: bool = False) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, epochs, drawn, taken.

    With whole, all columns of docs go along; of these, ones that are named like the new ones are replaced.

    Every document of a source is taken for each complete epoch that fits its target. The rest of the
    target goes to documents in the order of their exponential keys: those before the running sum of
    sizes reaches it, and the one that crosses it if its greater part lies inside.

    A source is never sorted in one task. Keys of weight w are exponential with rate w, so counts of a source's weights, in steps of
    1 / WEIGHT_STEPS, give the share of its rows whose keys are below any key; buckets of about bucket_rows rows are
    cut by that share, even at all weights. Sums of buckets are prefix-summed, and only inside a bucket are rows
    sorted. Texts are read once: rows are written with their sizes and keys, the draw works on narrow rows, and whole ones are
    joined to what was drawn once, at the end.

    A null text has size 0 and is never drawn alone; null sources form one source, the last. Texts of any length count as one
    size. An empty table gives an empty one. Rows with equal doc_id share a key and are told apart by size; equal rows are
    interchangeable. Rows without doc_id are keyed by their text. The draw depends on seed and these only, so reruns agree.
    """
    text = F.col("text")
    row = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if whole else ["doc_id", "source"]))).alias("_row")
    rows = docs.select(row, "doc_id", F.coalesce("source", F.lit(NO_SOURCE)).alias("source_key"), words_in(text).alias("size"), quality_weight(text).alias("weight"), exponential_key(F.col("doc_id"), text, quality_weight(text), seed).alias("key"))
    rows = store.written(rows.withColumn("_id", F.monotonically_increasing_id()), "sized")
    narrow = rows.drop("_row") if whole else rows
    by_weight = narrow.groupBy("source_key", (F.round(F.col("weight") * WEIGHT_STEPS) / WEIGHT_STEPS).alias("w")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    plan = by_weight.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.sum("n").alias("n_docs"), F.collect_list(F.struct("w", "n")).alias("weights"))
    targets = source_targets(plan.select("source_key", "source_size"), weights, most)
    plan = plan.drop("source_size").join(targets, "source_key").withColumn("epochs", F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long"))
    plan = plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("buckets", F.ceil(F.col("n_docs") / bucket_rows))
    plan = store.written(plan, "plan")  # of known size: sent whole while small, else joined by a plain shuffle that splits hot sources
    dealt = narrow.join(plan, "source_key").withColumn("bucket", key_bucket()).drop("weights", "weight")
    sums = dealt.groupBy("source_key", "bucket").agg(F.sum("size").alias("in_bucket"))
    offsets = sums.select("source_key", "bucket", (F.sum("in_bucket").over(W.partitionBy("source_key").orderBy("bucket")) - F.col("in_bucket")).alias("offset"))
    inside = W.partitionBy("source_key", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = dealt.join(offsets, ["source_key", "bucket"]).withColumn("before", F.col("offset") + F.sum("size").over(inside) - F.col("size"))
    drawn = F.col("before") + F.col("size") / 2 <= F.col("budget")
    taken = F.col("epochs") * F.col("size") + F.when(drawn, F.col("size")).otherwise(0)
    new = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "epochs": F.col("epochs"), "drawn": drawn, "taken": taken}
    old = [F.col(f"_row.`{c}`") for c in (docs.columns if whole else ["doc_id", "source"]) if c not in new]
    if not whole:
        return placed.select(*old, *(x.alias(k) for k, x in new.items()))
    decided = placed.select("_id", *(x.alias(k) for k, x in new.items()))
    return rows.select("_row", "_id").join(decided, "_id").select(*old, *new)


def key_bucket() -> Column:
    """The bucket of a key: the share of its source's rows that are expected below it, times buckets."""
    below = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x["n"] * (1 - F.exp(-x["w"] * F.col("key"))))
    return F.least(F.floor(below / F.col("n_docs") * F.col("buckets")), F.col("buckets") - 1).cast("long")
