"""Counting the rows that break a table's declared constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.schemas import MESSAGE_STATES

TELEMETRY_RULES = {
    "not_null": ["id", "uuid", "msg_uuid", "gpu_id", "metric_name", "timestamp", "ingested_at"],
    "unique": [["id"], ["msg_uuid"]],
}
QUEUE_V1_RULES = {
    "not_null": ["id", "topic", "msg_uuid", "payload", "state", "attempts", "created_at", "updated_at"],
    "unique": [["id"], ["topic", "msg_uuid"]],
    "check": {"state": f"state IN {tuple(MESSAGE_STATES)}"},
}


def constraint_report(
    df: DataFrame,
    not_null: list[str] | None = None,
    unique: list[list[str]] | None = None,
    check: dict[str, str] | None = None,
) -> DataFrame:
    """``constraint`` and ``violations``: the rows to remove or mend for it to hold.

    NOT NULL and CHECK are counted in one pass; a NULL passes a CHECK. Each UNIQUE key is
    counted per key first, copies combined before the shuffle; a key with NULL is unique.
    """
    counted = [
        F.count_if(F.col(c).isNull()).alias(f"not_null({c})") for c in not_null or []
    ] + [
        F.count_if(~F.expr(condition)).alias(f"check({name})") for name, condition in (check or {}).items()
    ]
    reports = []
    if counted:
        totals = df.agg(*counted)
        rows = F.array(*[
            F.struct(F.lit(c).alias("constraint"), F.col(f"`{c}`").alias("violations"))
            for c in totals.columns
        ])
        reports.append(totals.select(F.explode(rows).alias("_r")).select("_r.*"))
    for key in unique or []:
        present = " AND ".join(f"{c} IS NOT NULL" for c in key)
        extra = df.filter(present).groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("_extra"))
        reports.append(extra.agg(
            F.lit(f"unique({', '.join(key)})").alias("constraint"),
            F.coalesce(F.sum("_extra"), F.lit(0).cast("bigint")).alias("violations"),
        ))
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report
