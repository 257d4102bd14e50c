"""Insert-if-absent and first-wins de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key, the first in ``order`` (ties and no order: the least row).

    An aggregate, so that copies meet within each task before the shuffle: a key with very
    many copies costs each task one row.
    """
    order = [c for c in order or [] if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    # The keys come from the grouping, not from the row: a join on them needs no new shuffle.
    return first.select(*[
        F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns
    ])


def insert_if_absent(
    target: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
) -> DataFrame:
    """The rows of ``batch`` whose key is not in ``target``, one per key.

    Both sides have one row per key by then, so a hot key cannot skew the join, and only the
    key columns of ``target`` are read. A table that does not exist yet is None. Exact with
    one writer per table.
    """
    fresh = dedup_first(batch, keys, order)
    if target is None:
        return fresh
    return fresh.join(target.select(*keys), keys, "left_anti").select(*batch.columns)


def matching_keys(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of a large ``target`` that ``batch`` has too, for inserts of small batches.

    For a batch whose size Spark knows (a table or a filled cache), its keys go to the scan of
    ``target`` if they fit Spark's broadcast limit, and nothing but matching keys is shuffled.
    """
    return target.select(*keys).join(batch.select(*keys), keys, "left_semi")


def insert_counts(
    target: DataFrame, batch: DataFrame, keys: list[str], by: str, inserted: str
) -> DataFrame:
    """Per value of ``by``, which is one of ``keys``, the rows inserted and the duplicates.

    Of the target only keys that the batch has too go any further than its scan, where the batch's keys fit a broadcast.
    """
    copies = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    present = matching_keys(target, batch, keys).distinct().withColumn("_present", F.lit(True))
    seen = copies.join(present, keys, "left")
    fresh = F.count_if(F.col("_present").isNull())
    return seen.groupBy(by).agg(
        fresh.alias(inserted), (F.sum("_copies") - fresh).alias("duplicates")
    )
