"""Delivery state from the lease and acknowledgement tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEASE_KEEP = ["lease_id", "ids", "served_at", "lease_seconds"]


def _as_time(as_of: Column | dt.datetime | str) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _micros_held(until: Column) -> Column:
    return F.unix_micros(until.cast("timestamp")) - F.unix_micros(F.col("served_at").cast("timestamp"))


def _timeout_micros() -> Column:
    return F.col("lease_seconds").cast("long") * 1_000_000


def first_acks(acks: DataFrame) -> DataFrame:
    """One row per lease: later acknowledgements find nothing. Repeats meet before the shuffle."""
    return acks.groupBy("lease_id").agg(F.min("acked_at").alias("acked_at"))


def effective_acks(leases: DataFrame, acks: DataFrame) -> DataFrame:
    """The acknowledgements in time: held no longer than the lease allows."""
    return (
        leases.select(*_LEASE_KEEP).join(first_acks(acks), "lease_id")
        .filter(_micros_held(F.col("acked_at")) <= _timeout_micros())
        .select("lease_id", "acked_at", F.size("ids").cast("bigint").alias("acked"))
    )


def acked_count(leases: DataFrame, acks: DataFrame) -> DataFrame:
    """Per lease and time of acknowledgement: how many came, and the messages they settle.

    The first one in time settles the whole lease; unknown, repeated or late ones settle 0.
    """
    arrived = acks.groupBy("lease_id", "acked_at").agg(F.count(F.lit(1)).alias("replies"))
    return arrived.join(effective_acks(leases, acks), ["lease_id", "acked_at"], "left").select(
        "lease_id", "acked_at", "replies",
        F.coalesce("acked", F.lit(0).cast("bigint")).alias("acked"),
    )


def settled_leases(leases: DataFrame, acks: DataFrame, as_of: Column | dt.datetime | str) -> DataFrame:
    """Every lease served by ``as_of`` with its status then: acked, in_flight or expired."""
    now = _as_time(as_of)
    acked = first_acks(acks)
    served = leases.select(*_LEASE_KEEP).filter(F.col("served_at").cast("timestamp") <= now)
    joined = served.join(acked, "lease_id", "left")
    in_time = (_micros_held(F.col("acked_at")) <= _timeout_micros()) & (
        F.col("acked_at").cast("timestamp") <= now
    )
    status = (
        F.when(in_time, "acked")
        .when(_micros_held(now) > _timeout_micros(), "expired")
        .otherwise("in_flight")
    )
    return joined.withColumn("status", status)


def expired_leases(leases: DataFrame, acks: DataFrame, as_of: Column | dt.datetime | str) -> DataFrame:
    """Leases held longer than they may be, strictly, without an acknowledgement in time."""
    return settled_leases(leases, acks, as_of).filter("status = 'expired'").select(*_LEASE_KEEP)


def outstanding_leases(leases: DataFrame, acks: DataFrame, as_of: Column | dt.datetime | str) -> DataFrame:
    return settled_leases(leases, acks, as_of).filter("status = 'in_flight'").select(*_LEASE_KEEP)


def _history(statuses: DataFrame) -> DataFrame:
    """One row per message that was ever served: in how many leases, and how those stand."""
    served = statuses.select(F.explode("ids").alias("id"), "status")
    return served.groupBy("id").agg(
        F.count_if(F.col("status") == "acked").alias("_acked"),
        F.count_if(F.col("status") == "in_flight").alias("_in_flight"),
        F.count(F.lit(1)).alias("_served"),
    )


def message_state(
    queue: DataFrame, leases: DataFrame, acks: DataFrame, as_of: Column | dt.datetime | str
) -> DataFrame:
    """Per queued message its state (ready, in_flight, acked) and how often it was served.

    A message's leases are reduced to flags before they meet the queue: one row per id on
    both sides of that join.
    """
    return states_of_messages(queue, settled_leases(leases, acks, as_of))


def states_of_messages(queue: DataFrame, statuses: DataFrame) -> DataFrame:
    """The same from leases whose ``status`` is known, such as those that the lease stream has written."""
    history = _history(statuses)
    state = (
        F.when(F.col("_acked") > 0, "acked").when(F.col("_in_flight") > 0, "in_flight")
        .otherwise("ready")
    )
    return queue.select("id").join(history, "id", "left").select(
        "id", state.alias("state"), F.coalesce("_served", F.lit(0).cast("bigint")).alias("served")
    )


def redelivery(
    queue: DataFrame, leases: DataFrame, acks: DataFrame, as_of: Column | dt.datetime | str
) -> DataFrame:
    """Messages that will be served again: served before, neither acknowledged nor in flight."""
    again = _history(settled_leases(leases, acks, as_of)).filter("_acked = 0 AND _in_flight = 0")
    return queue.join(again.select("id", F.col("_served").alias("served")), "id").select(
        *queue.columns, "served"
    )
