"""The given ``events`` table as readings, queue, telemetry, lease and request tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.identity import assign_msg_uuid, fnv1a_partition
from gaugeline.functions.payload import to_payload
from gaugeline.functions.scalars import null_if_empty
from gaugeline.operators.publish import queue_rows
from gaugeline.operators.queue import grant_leases, lease_batches, owner_of
from gaugeline.schemas import READING_COLUMNS, TELEMETRY_COLUMNS, TOPIC
from gaugeline.session import configure

OWNERS = 4
SPLIT_TIME = "2024-01-10 00:00:00"


def load(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the other engine has them."""
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema if isinstance(f.dataType, T.TimestampType)
    })


def readings(events: DataFrame) -> DataFrame:
    """``id`` and the 12 columns of a reading."""
    user = F.col("user_id")
    slot = (user % 8).cast("string")

    def maybe(text) -> Column:
        return F.when(F.col("event_id") % 3 == 0, "").otherwise(text)

    columns = {
        "timestamp": F.col("ts").cast("timestamp"),
        "metric_name": F.col("event_type"),
        "gpu_id": slot,
        "device": F.concat(F.lit("nvidia"), slot),
        "uuid": F.concat(F.lit("GPU-"), F.lpad(user.cast("string"), 6, "0")),
        "model_name": F.when(user % 2 == 0, "A100").otherwise("H100"),
        "hostname": F.concat(F.lit("host-"), F.lpad(F.expr("user_id div 8").cast("string"), 4, "0")),
        "container": maybe(F.lit("trainer")),
        "pod": maybe(F.concat(F.lit("pod-"), slot)),
        "namespace": maybe(F.lit("ml")),
        "value": F.col("value"),
        "labels_raw": F.col("props"),
    }
    return events.select(
        F.col("event_id").alias("id"), *[columns[c].alias(c) for c in READING_COLUMNS]
    )


def queue(events: DataFrame) -> DataFrame:
    """Every event as a queued message."""
    rows = assign_msg_uuid(to_payload(readings(events)), ["id"]).withColumns({
        "topic": F.lit(TOPIC),
        "partition_key": fnv1a_partition(F.col("gpu_id")),
    })
    return queue_rows(rows, F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))


def queue_keys(events: DataFrame) -> DataFrame:
    """The queue without its payloads."""
    rows = assign_msg_uuid(readings(events), ["id"])
    return rows.select(
        "id", F.lit(TOPIC).alias("topic"), "msg_uuid", "timestamp",
        fnv1a_partition(F.col("gpu_id")).alias("partition_key"),
    )


def telemetry(events: DataFrame) -> DataFrame:
    """Every event as a stored telemetry row."""
    rows = assign_msg_uuid(null_if_empty(readings(events)), ["id"])
    return rows.withColumn("ingested_at", F.col("timestamp") + F.expr("INTERVAL 1 SECOND")).select(
        *TELEMETRY_COLUMNS
    )


def is_early() -> Column:
    """The events a table already holds when the others arrive."""
    return F.col("ts") < F.lit(SPLIT_TIME).cast("timestamp_ntz")


def redelivered(events: DataFrame) -> DataFrame:
    """Every event, and those of type error a second time."""
    return events.unionByName(events.filter("event_type = 'error'"))


def owned(events: DataFrame) -> DataFrame:
    """Queue keys with the owner of their partition."""
    return queue_keys(events).withColumn("owner", owner_of(F.col("partition_key"), OWNERS))


def leases(events: DataFrame) -> DataFrame:
    """Each owner's messages leased in batches of 100, served when the last one is there."""
    return grant_leases(lease_batches(owned(events)), F.col("timestamp"))


def acks(lease_table: DataFrame) -> DataFrame:
    """Every fifth batch is acknowledged too late, other even ones in time, the rest never."""
    seconds = F.when(F.col("batch") % 5 == 0, 31).when(F.col("batch") % 2 == 0, 10)
    return (
        lease_table.withColumn("_after", seconds).filter("_after IS NOT NULL")
        .select(
            "lease_id",
            F.expr("served_at + make_dt_interval(0, 0, 0, _after)").alias("acked_at"),
        )
    )


def as_of(lease_table: DataFrame) -> dt.datetime:
    """Five seconds after the last lease served before a fixed day."""
    row = lease_table.filter("served_at < TIMESTAMP '2024-01-20 00:00:00'").agg(
        F.max(F.col("served_at").cast("timestamp_ntz"))
    ).first()
    return (row[0] + dt.timedelta(seconds=5)).replace(tzinfo=dt.timezone.utc)


def after_first_lease(lease_table: DataFrame) -> dt.datetime:
    """Five seconds after the first lease was served."""
    row = lease_table.agg(F.min(F.col("served_at").cast("timestamp_ntz"))).first()
    return (row[0] + dt.timedelta(seconds=5)).replace(tzinfo=dt.timezone.utc)


def busiest_gpu(events: DataFrame) -> str:
    """The GPU with the most readings; the least id of several."""
    counted = readings(events).groupBy("uuid").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "uuid").first()["uuid"]


def requests(events: DataFrame) -> DataFrame:
    """Publish requests of up to four messages each, some without topic or with bad messages."""
    rows = to_payload(readings(events)).withColumn("user_id", F.col("uuid").substr(5, 6).cast("long"))
    metric = F.col("metric_name")
    message = (
        F.when((metric == "error") & (F.col("user_id") % 3 == 0), F.lit('{"value": 1}'))
        .when((metric == "error") & (F.col("user_id") % 3 == 1), F.lit('{"gpu_id": 7}'))
        .when((metric == "signup") & (F.col("user_id") % 3 == 2), F.lit("[]"))
        .when((metric == "signup") & (F.col("user_id") % 7 == 0), F.lit('{"gpu_id": ""}'))
        .otherwise(F.col("payload"))
    )
    placed = rows.select(
        F.expr("id div 4").alias("request_id"),
        F.struct("id", message.alias("m"), "metric_name").alias("r"),
    )
    grouped = placed.groupBy("request_id").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    first = F.get(F.col("rs"), F.lit(0))["metric_name"]
    return grouped.select(
        "request_id",
        F.when(first == "purchase", "").otherwise(F.concat(F.lit("t-"), first)).alias("topic"),
        F.transform("rs", lambda r: r["m"]).alias("messages"),
    )
