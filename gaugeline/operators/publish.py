"""The publish path: envelopes to queue rows, with the counts replied to the senders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.identity import assign_msg_uuid, fnv1a_partition
from gaugeline.functions.payload import extract_gpu_id, publish_problem
from gaugeline.operators.merge import insert_counts
from gaugeline.schemas import QUEUE_COLUMNS, VIRTUAL_PARTITIONS


def validate_publish(requests: DataFrame) -> DataFrame:
    """Add ``error``: why the whole request is refused, NULL when it is accepted.

    A request's messages are checked within its row; nothing is shuffled. Raw bodies that could not be read
    (``invalid_json``) are refused as such.
    """
    invalid = "invalid_json" if "invalid_json" in requests.columns else "false"
    return requests.withColumn("error", publish_problem(invalid=invalid))


def explode_publish(requests: DataFrame) -> DataFrame:
    """One row per message, with its place in the request."""
    others = [c for c in requests.columns if c != "messages"]
    return requests.select(*others, F.posexplode("messages").alias("index", "payload"))


def publish_messages(
    requests: DataFrame,
    keys: list[str] | None = ("request_id", "index"),
    partitions: int = VIRTUAL_PARTITIONS,
) -> DataFrame:
    """The messages of the accepted requests with GPU, partition and message id."""
    accepted = validate_publish(requests).filter("error IS NULL").drop("error")
    messages = explode_publish(accepted).withColumn("gpu_id", extract_gpu_id("payload"))
    hashed = messages.withColumn("partition_key", fnv1a_partition(F.col("gpu_id"), partitions))
    return assign_msg_uuid(hashed, list(keys) if keys else None)


def queue_rows(messages: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Messages in the layout of the queue table; they bring their own ``id``."""
    at = created_at if created_at is not None else F.current_timestamp()
    return messages.withColumn("created_at", at).select(*QUEUE_COLUMNS)


def publish_counts(
    queue: DataFrame, batch: DataFrame, keys: tuple[str, ...] = ("topic", "msg_uuid")
) -> DataFrame:
    """Messages accepted and duplicate per topic, when ``batch`` goes into ``queue``."""
    return insert_counts(queue, batch, list(keys), "topic", "accepted")


def group_by_topic(requests: DataFrame) -> DataFrame:
    """What is pending per topic. The write itself is one ``partitionBy("topic")``."""
    return requests.groupBy("topic").agg(
        F.count(F.lit(1)).alias("requests"), F.sum(F.size("messages")).alias("messages")
    )


def apportion(
    requests: DataFrame,
    totals: DataFrame,
    groups: tuple[str, ...] = ("flush_id", "topic"),
    order: str = "request_id",
    size: str = "n",
    salts: int = 16,
) -> DataFrame:
    """Share a flush's ``accepted`` and ``duplicates`` among its requests.

    Each gets ``total * n div sum(n)``, the last one what is left over. No window over a flush:
    shares depend only on the size, so their sum comes from the counts per size, and one
    row per flush is joined back. Requests may be many for one flush; that side is salted.
    """
    keys = list(groups)
    shared = totals.select(*keys, "accepted", "duplicates")
    sizes = requests.groupBy(*keys, size).agg(
        F.count(F.lit(1)).alias("_requests"), F.max(order).alias("_last")
    )
    whole = sizes.groupBy(*keys).agg(
        F.sum(F.col(size) * F.col("_requests")).alias("_sum"),
        F.max("_last").alias("_last"),
    )
    flush = whole.join(shared, keys)

    def share(total: str) -> Column:
        even = F.expr(f"{total} * {size} div _sum")
        return F.when(F.col("_sum") > 0, even).otherwise(F.lit(0).cast("bigint"))

    given = sizes.join(flush.drop("_last"), keys).groupBy(*keys).agg(
        *[
            F.sum(share(t) * F.col("_requests")).alias(f"_all_{t}")
            for t in ("accepted", "duplicates")
        ],
    )
    flush = flush.join(given, keys)
    spread = requests.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    copies = flush.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    joined = spread.join(copies, [*keys, "_salt"])
    is_last = F.col(order) == F.col("_last")

    def final(total: str) -> Column:
        # The shares of all requests include the last one's own, which it does not take.
        rest = F.col(total) - (F.col(f"_all_{total}") - share(total))
        return F.when(is_last, rest).otherwise(share(total))

    return joined.select(
        *requests.columns,
        final("accepted").alias("accepted"),
        final("duplicates").alias("duplicates"),
    )
