"""Ranks and pages that do not put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.session import work_folder

BLOCK_BITS = 20


def _blocked(df: DataFrame, groups: list[str], order: str) -> DataFrame:
    """Rows that have a group, with the block of 2^20 ids they fall into."""
    known = df.filter(" AND ".join(f"{g} IS NOT NULL" for g in groups))
    return known.withColumn("_block", F.shiftright(F.col(order), BLOCK_BITS))


def _block_starts(blocked: DataFrame, groups: list[str]) -> DataFrame:
    """How many rows of its group come before each block, as ``_start``.

    Running sums go over blocks of blocks first, which bounds every window by 2^20 block
    counts even for sparse ids. The counts read only the group and id columns and are
    combined before their shuffle.
    """
    counts = (
        blocked.groupBy(*groups, "_block").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_span", F.shiftright("_block", BLOCK_BITS))
    )
    spans = counts.groupBy(*groups, "_span").agg(F.sum("_n").alias("_n"))
    span_window = Window.partitionBy(*groups).orderBy("_span").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = spans.select(
        *groups, "_span", F.coalesce(F.sum("_n").over(span_window), F.lit(0)).alias("_span_start")
    )
    block_window = Window.partitionBy(*groups, "_span").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        counts.withColumn("_in_span", F.coalesce(F.sum("_n").over(block_window), F.lit(0)))
        .join(spans, [*groups, "_span"])
        .select(*groups, "_block", (F.col("_span_start") + F.col("_in_span")).alias("_start"))
    )


def fifo_rank(df: DataFrame, groups: list[str], order: str = "id", rank: str = "rank") -> DataFrame:
    """1, 2, 3, … within each group in the order of a unique LONG column.

    Ids are cut into blocks of 2^20. A block holds at most that many rows whatever the skew,
    so rows are numbered within (group, block), and the block's start is added. Rows are
    shuffled once. Rows without a group are left out.
    """
    blocked = _blocked(df, groups, order)
    keys = [*groups, "_block"]
    in_block = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return (
        blocked.withColumn("_nth", in_block)
        .join(_block_starts(blocked, groups), keys)
        .withColumn(rank, F.col("_start") + F.col("_nth"))
        .select(*df.columns, rank)
    )


def pages(
    df: DataFrame, groups: list[str], order: list[str], item: Column, size: int, name: str
) -> DataFrame:
    """Each group's items in order, as arrays: ``page`` k holds the items k x ``size`` and following.

    Rows are range-partitioned and sorted by (group, order), so a very large group spreads
    over several tasks. They are written once, because running the same again could cut the ranges
    elsewhere. Each task's rows of a group are numbered, and the number of those in the tasks
    before is added. All pages but a group's last are full, however many tasks there are. ``order`` has to
    be unique within a group; rows without a group are left out.
    """
    spark = df.sparkSession
    known = df.filter(" AND ".join(f"{g} IS NOT NULL" for g in groups)) if groups else df
    placed = (
        known.select(*groups, *order, item.alias("_item"))
        .repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
        .select(*groups, "_item", F.monotonically_increasing_id().alias("_at"))
    )
    folder = work_folder(spark, "pages")
    placed.write.parquet(folder)
    stored = spark.read.schema(placed.schema).parquet(folder)
    stored = stored.withColumn("_task", F.shiftright("_at", 33))
    keys = [*groups, "_task"]
    counts = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    tasks = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(tasks), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
    numbered = stored.withColumn("_nth", nth).join(starts, keys).withColumn(
        "_at", F.col("_start") + F.col("_nth") - 1
    )
    collected = numbered.groupBy(*groups, F.expr(f"_at div {int(size)}").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_item"))).alias("_items")
    )
    return collected.select(
        *groups, "page", F.transform("_items", lambda x: x["_item"]).alias(name)
    )


def first_per_group(df: DataFrame, groups: list[str], order: str, limit: int) -> DataFrame:
    """The ``limit`` first rows of each group, in the order of a unique LONG column.

    Only the blocks that can hold the first rows are kept, as their starts tell, and numbered
    each on its own; those without a group are left out.
    """
    blocked = _blocked(df, groups, order)
    keys = [*groups, "_block"]
    starts = _block_starts(blocked, groups).filter(F.col("_start") < limit)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    near = blocked.join(starts, keys).withColumn("_nth", nth).filter(F.col("_nth") <= limit)
    return near.filter(F.col("_start") + F.col("_nth") <= limit).select(*df.columns)
