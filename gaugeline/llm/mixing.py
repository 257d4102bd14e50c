"""Mixing sources to target weights by hash thresholds found in histograms.

Every document has a fixed 60-bit hash. A source that is to give T of its S words gives every document
floor(T / S) times, and once more those documents whose hash lies at or below a threshold. The threshold
is found digit by digit: words are summed by source and 12-bit hash bucket, the bucket in
which the budget ends is the source's next digit, and only documents of that bucket are summed by the
next 12 bits, until one hash is left in it. Documents are never sorted; a source of any size is at most
4,096 sums per level, combined in each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.common import n_words, saved

DIGIT_BITS = 12
LEVELS = 5  # five digits of 12 bits make up the hash
MOST_COPIES = 3
WEIGHTS = (5, 2, 1)


def document_hash(key: Column, seed: int = 0) -> Column:
    """60 bits of the MD5 of the key's text and a seed; a null key counts as the empty text."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, source: str = "source", size: str = "source_size",
                   weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source, ``target`` added: the words it is to give.

    Sources by code point, null last, get the weights in turn. All sizes together are shared by weight; a
    target stops at ``most`` times its source's size, and what is cut off is shared again by weight
    among the others. A source is capped exactly if the level at which it reaches its cap is within
    reach of the total, so that one running sum in the order of those levels settles all.
    This gathers one row per source, never documents.
    """
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    before = everything.orderBy("_level", "_place").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sizes.withColumn("_place", place).withColumn("_weight", weight.cast("long"))
        .withColumn("_cap", F.col(size) * most)
        .withColumn("_level", F.col("_cap") / F.col("_weight"))
        .withColumn("_caps", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_rest", F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_total", F.sum(size).over(everything))
        .withColumn("_capped", F.col("_cap") * F.col("_rest") <= (F.col("_total") - F.col("_caps")) * F.col("_weight"))
        .withColumn("_open", F.sum(F.when(~F.col("_capped"), F.col("_weight"))).over(everything))
        .withColumn("_spent", F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything), F.lit(0)))
    )
    share = (F.col("_total") - F.col("_spent")) * F.col("_weight") / F.col("_open")
    return rows.select(source, size, F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(share).alias("target"))


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(src, threshold): for each source the hash up to which its documents fit the budget.

    ``docs`` has src, h, size; ``budgets`` has src, budget (words). Documents of one hash go together;
    the last one is in if that comes nearer to the budget. -1 where nothing fits.
    """
    state = budgets.select("src", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("used"))
    done = None
    for level in range(LEVELS):
        shift = DIGIT_BITS * (LEVELS - 1 - level)
        inside = F.shiftright("h", shift + DIGIT_BITS) == F.col("prefix")
        bucket = F.shiftright("h", shift)
        sums = (
            docs.join(state, docs.src.eqNullSafe(state.src)).where(inside)
            .groupBy(state.src, "budget", "used", bucket.alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("h").alias("least"), F.max("h").alias("most"))
        )
        by_bucket = Window.partitionBy("src").orderBy("bucket")
        upto = sums.withColumn("upto", F.col("used") + F.sum("words").over(by_bucket))
        before = F.col("upto") - F.col("words")
        # The bucket in which the budget ends: the first that reaches it, or else the last one.
        ends = (
            upto.groupBy("src", "budget")
            .agg(F.min_by(
                F.struct("bucket", before.alias("used"), "upto", "least", "most"),
                F.struct((F.col("upto") < F.col("budget")).cast("int"),
                         F.when(F.col("upto") < F.col("budget"), -F.col("bucket")).otherwise(F.col("bucket"))),
            ).alias("e"))
            .select("src", "budget", "e.*")
        )
        ends = saved(ends, "mix-level")
        single = (F.col("least") == F.col("most")) | (F.col("upto") <= F.col("budget"))
        if level == LEVELS - 1:
            single = F.lit(True)
        nearer = F.col("upto") - F.col("budget") < F.col("budget") - F.col("used")
        found = ends.where(single).select(
            "src", F.when((F.col("upto") <= F.col("budget")) | nearer, F.col("most"))
            .otherwise(F.col("least") - 1).alias("threshold"))
        done = found if done is None else done.unionByName(found)
        state = ends.where(~single).select("src", "budget", F.col("bucket").alias("prefix"), "used")
        if level == LEVELS - 1 or state.isEmpty():
            return done
    return done


def mixing_plan(docs: DataFrame, key: str, text: str, source: str, weights: tuple[int, ...],
                most: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The documents as (k, src, h, size), and per source (s, source_size, target, whole, threshold)."""
    slim = saved(docs.select(
        F.col(key).alias("k"), F.col(source).alias("src"),
        document_hash(F.col(key), seed).alias("h"), n_words(F.col(text)).alias("size")), "mix-sizes")
    sizes = slim.groupBy("src").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, "src", "source_size", weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = saved(
        targets.withColumn("whole", whole.cast("long"))
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    some = plan.where(F.col("budget") > 0).select("src", "budget")
    limits = saved(thresholds(slim, some), "mix-thresholds").withColumnRenamed("src", "s")
    plan = plan.join(limits, F.col("src").eqNullSafe(F.col("s")), "left").drop("s", "budget")
    return slim, saved(plan.withColumnRenamed("src", "s"), "mix-plan")


def _copies(h: Column) -> Column:
    return F.col("whole") + F.coalesce((h <= F.col("threshold")).cast("long"), F.lit(0))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 0) -> DataFrame:
    """One row per document: key, size, source_size, target, copies, taken.

    ``copies`` (0 to ``most``) says how often the mix takes the document and ``taken`` is the number of words
    that makes. Each source's taken words differ from its target by at most half the documents of one
    hash, which is one document unless keys repeat; repeated rows of a key are taken alike. Null texts
    have size 0, a null source is a source of its own, the last; an empty table gives no rows. The columns
    are those named here, whatever others ``docs`` has.
    """
    slim, plan = mixing_plan(docs, key, text, source, weights, most, seed)
    # The plan has one small row per source; Spark's own size check decides whether it is broadcast.
    return (
        slim.join(plan, F.col("src").eqNullSafe(F.col("s")))
        .withColumn("copies", _copies(F.col("h")))
        .select(F.col("k").alias(key), "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 0) -> DataFrame:
    """The mixed table itself: every document as often as the mix takes it, with its own columns.

    The documents are filtered where they are read: only the plan travels.
    """
    _, plan = mixing_plan(docs, key, text, source, weights, most, seed)
    plan = plan.select(F.struct("*").alias("_plan"))
    copies = F.col("_plan.whole") + F.coalesce(
        (document_hash(docs[key], seed) <= F.col("_plan.threshold")).cast("long"), F.lit(0))
    taken = docs.join(plan, docs[source].eqNullSafe(F.col("_plan.s"))).where(copies > 0)
    return taken.select(
        *[docs[c] for c in docs.columns],
        F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy_of_mix"),
    ).drop("_copy_of_mix")
