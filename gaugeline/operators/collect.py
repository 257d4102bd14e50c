"""The collect path: leased messages to telemetry rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.identity import canonical_uuid
from gaugeline.functions.payload import parse_payload
from gaugeline.functions.scalars import default_value, null_if_empty
from gaugeline.operators.merge import insert_if_absent
from gaugeline.schemas import TELEMETRY_COLUMNS

# Why a message is set aside.
BAD_PAYLOAD = "payload cannot be read"
BAD_MSG_UUID = "msg_uuid is not a UUID"
NO_UUID = "uuid is missing"


def telemetry_rows(messages: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Messages as telemetry rows plus ``parse_ok`` and ``problem``.

    ``problem`` is NULL for rows fit to be stored. In ``strict`` mode a message id or a
    missing ``uuid`` that the table would refuse fails the job, as it fails the whole batch.
    Use :func:`storable` and :func:`quarantined` to split the result.
    """
    parsed = default_value(null_if_empty(parse_payload(messages)))
    checked = parsed.withColumn("_msg_uuid", canonical_uuid(F.col("msg_uuid")))
    refused = (
        F.when(F.col("_msg_uuid").isNull(), BAD_MSG_UUID).when(F.col("uuid").isNull(), NO_UUID)
    )
    if mode == "strict":
        refused = F.when(refused.isNotNull(), F.raise_error(refused).cast("string"))
    elif mode != "quarantine":
        raise ValueError(f"mode must be 'quarantine' or 'strict', not {mode!r}")
    problem = F.when(~F.col("parse_ok"), BAD_PAYLOAD).otherwise(refused)
    return checked.withColumns({
        "problem": problem,
        "msg_uuid": F.coalesce("_msg_uuid", "msg_uuid"),
    }).drop("_msg_uuid")


def storable(rows: DataFrame) -> DataFrame:
    return rows.filter("problem IS NULL")


def quarantined(rows: DataFrame) -> DataFrame:
    """The messages set aside, as they came, with the reason."""
    keep = [c for c in ("id", "lease_id", "topic", "msg_uuid", "payload", "problem")
            if c in rows.columns]
    return rows.filter("problem IS NOT NULL").select(*keep)


def persist_telemetry(
    telemetry: DataFrame,
    messages: DataFrame,
    ingested_at: Column | None = None,
    order: tuple[str, ...] = ("id",),
    mode: str = "quarantine",
) -> DataFrame:
    """The rows that a batch of messages adds to ``telemetry``."""
    rows = storable(telemetry_rows(messages, mode))
    at = ingested_at if ingested_at is not None else F.current_timestamp()
    batch = rows.withColumn("ingested_at", at).select(*TELEMETRY_COLUMNS)
    return insert_if_absent(telemetry, batch, ["msg_uuid"], list(order))


def persist_counts(telemetry: DataFrame, rows: DataFrame, order: str = "id") -> DataFrame:
    """Rows persisted and duplicate per lease, when ``rows`` go into ``telemetry``.

    The first row of a message id counts for its lease. Copies are combined before the
    shuffle; a lease may hold copies of its own rows or of another lease's.
    """
    total = rows.groupBy("lease_id").agg(F.count(F.lit(1)).alias("_rows"))
    winners = rows.groupBy("msg_uuid").agg(
        F.min(F.struct(order, "lease_id")).alias("_first")
    )
    fresh = (
        winners.join(telemetry.select("msg_uuid"), "msg_uuid", "left_anti")
        .groupBy(F.col("_first.lease_id").alias("lease_id"))
        .agg(F.count(F.lit(1)).alias("_fresh"))
    )
    persisted = F.coalesce(F.col("_fresh"), F.lit(0)).cast("bigint")
    return total.join(fresh, "lease_id", "left").select(
        "lease_id", persisted.alias("persisted"), (F.col("_rows") - persisted).alias("duplicates")
    )


def lease_outcome(parsed: DataFrame) -> DataFrame:
    """Whether each lease is persisted and acknowledged, and how many rows it loses.

    A lease of nothing but unreadable messages is not acknowledged; one with a readable
    message is, as a whole. With ``problem``, as :func:`telemetry_rows` gives it, a lease with a
    row that the table refuses fails as one insert: it stores nothing and stays unacknowledged.
    """
    if "problem" in parsed.columns:
        parsed = parsed.withColumn("_refused", F.col("parse_ok") & F.col("problem").isNotNull())
    else:
        parsed = parsed.withColumn("_refused", F.lit(False))
    fails = F.bool_or("_refused")
    good = F.count_if("parse_ok")
    total = F.count(F.lit(1))
    return parsed.groupBy("lease_id").agg(
        F.when(fails, "fail").when(F.bool_or("parse_ok"), "persist").otherwise("skip").alias("outcome"),
        (F.bool_or("parse_ok") & ~fails).alias("acked"),
        F.when(fails, F.lit(0).cast("bigint")).otherwise(good).alias("persistable"),
        (total - good).alias("quarantined"),
    )
