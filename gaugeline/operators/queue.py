"""Reading the queue: partition ranges, owners, fetches, lease batches and deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.ranking import fifo_rank, first_per_group
from gaugeline.schemas import FETCH_LIMIT, LEASE_MAX, LEASE_SECONDS, VIRTUAL_PARTITIONS

MESSAGE_COLUMNS = ["id", "topic", "msg_uuid", "payload"]


def partition_ranges(
    spark: SparkSession, n: int, total: int = VIRTUAL_PARTITIONS
) -> DataFrame:
    """``owner``, ``start``, ``end`` (inclusive): ``total div n`` keys each, the last takes the rest."""
    n = max(n, 1)
    per = total // n
    owner = F.col("id").cast("int")
    return spark.range(n).select(
        owner.alias("owner"),
        (owner * per).alias("start"),
        F.when(owner == n - 1, total - 1).otherwise((owner + 1) * per - 1).alias("end"),
    )


def owner_of(partition_key: Column, n: int, total: int = VIRTUAL_PARTITIONS) -> Column:
    """The owner that :func:`partition_ranges` gives a key, by arithmetic instead of a join."""
    n = max(n, 1)
    per = total // n
    if per == 0:
        return F.lit(n - 1)
    return F.least(F.floor(partition_key / per).cast("int"), F.lit(n - 1))


def assign_owner(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add ``owner`` by any range table; a key in several ranges gives a row for each.

    A key is owned if it lies in a range, both ends included, whatever the number of
    partitions. Ranges become one row per key, so this is an equality join with a side as
    small as the number of partitions.
    """
    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    keys = (
        ranges.filter(start <= end)
        .select("owner", F.explode(F.sequence(start, end)).alias("partition_key"))
    )
    return df.join(keys, "partition_key").select(*df.columns, "owner")


def in_partition_range(df: DataFrame, start: int, end: int) -> DataFrame:
    return df.filter(F.col("partition_key").between(start, end))


def fetch_batch(
    queue: DataFrame, start: int, end: int, limit: int = FETCH_LIMIT
) -> DataFrame:
    """The oldest ``limit`` messages of a partition range, of any topic."""
    return in_partition_range(queue, start, end).select(*MESSAGE_COLUMNS).orderBy("id").limit(limit)


def fetch_batch_per_owner(
    queue: DataFrame, ranges: DataFrame, limit: int = FETCH_LIMIT
) -> DataFrame:
    """:func:`fetch_batch` for every owner at once."""
    owned = assign_owner(queue, ranges).select("owner", *MESSAGE_COLUMNS)
    return first_per_group(owned, ["owner"], "id", limit)


def lease_batches(
    owned: DataFrame, size: int = LEASE_MAX, owner: str = "owner", order: str = "id"
) -> DataFrame:
    """Add ``batch``: each owner's messages in FIFO order, ``size`` to a batch, from 0."""
    ranked = fifo_rank(owned, [owner], order, "_rank")
    return ranked.withColumn("batch", F.expr(f"(_rank - 1) div {int(size)}")).drop("_rank")


def grant_leases(
    batches: DataFrame,
    served_at: Column,
    consumer_id: Column | None = None,
    owner: str = "owner",
    lease_seconds: int = LEASE_SECONDS,
) -> DataFrame:
    """The lease table for batches of :func:`lease_batches`; ``ids`` is as long as a batch."""
    grouped = batches.groupBy(owner, "batch").agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.max(served_at).alias("served_at")
    )
    consumer = consumer_id if consumer_id is not None else F.concat(F.lit("consumer-"), F.col(owner))
    return grouped.select(
        F.concat_ws("-", F.lit("lease"), owner, "batch").alias("lease_id"),
        consumer.alias("consumer_id"),
        "ids", "served_at",
        F.lit(lease_seconds).alias("lease_seconds"),
        owner, "batch",
    )


def exclude_outstanding(batch: DataFrame, outstanding: DataFrame) -> DataFrame:
    """A fetched batch without the messages under lease, dropped after the limit."""
    taken = outstanding.select(F.explode("ids").alias("id"))
    return batch.join(taken, "id", "left_anti").select(*batch.columns)


def delete_acked(queue: DataFrame, done: DataFrame) -> DataFrame:
    """The messages that stay when the ids of ``done`` are deleted; none means all stay."""
    return queue.join(done.select("id"), "id", "left_anti").select(*queue.columns)


def deleted_count(queue: DataFrame, done: DataFrame) -> DataFrame:
    """One row: how many messages that deletes. Ids that are not queued do not count."""
    return (
        queue.select("id").join(done.select("id"), "id", "left_semi")
        .agg(F.count(F.lit(1)).alias("deleted_count"))
    )


def compact_queue(queue: DataFrame, done: DataFrame, path: str) -> None:
    """Write the queue without the deleted messages to a new folder."""
    kept = delete_acked(queue, done)
    (
        kept.repartitionByRange("partition_key", "id")
        .sortWithinPartitions("partition_key", "id")
        .write.mode("errorifexists").parquet(path)
    )


def backlog_utilization(
    queue: DataFrame, ranges: DataFrame, batch_size: int = FETCH_LIMIT
) -> DataFrame:
    """Per owner, its backlog as a share of one fetch; 0 when the batch size is not positive."""
    counts = queue.groupBy("partition_key").agg(F.count(F.lit(1)).alias("waiting"))
    return utilization(counts, ranges, batch_size)


def utilization(counts: DataFrame, ranges: DataFrame, batch_size: int = FETCH_LIMIT) -> DataFrame:
    """The same from the number of messages waiting in each partition, such as the running backlog."""
    waiting = assign_owner(counts.select("partition_key", "waiting"), ranges).groupBy("owner").agg(
        F.sum("waiting").alias("_waiting")
    )
    backlog = F.coalesce(F.col("_waiting"), F.lit(0)).cast("bigint")
    if batch_size > 0:
        ratio = F.least(backlog, F.lit(batch_size)) / F.lit(float(batch_size))
    else:
        ratio = F.lit(0.0)
    return ranges.join(waiting, "owner", "left").select(
        "owner", backlog.alias("backlog"), ratio.alias("utilization")
    )
