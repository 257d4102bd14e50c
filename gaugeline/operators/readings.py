"""The two questions asked of telemetry: which GPUs, and what one reported when."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.scalars import RFC3339_LOOSE
from gaugeline.operators.ranking import pages
from gaugeline.schemas import ENTRY_COLUMNS, WINDOW_END, WINDOW_START
from gaugeline.sources.tables import EVENT_DATE

PAGE_SIZE = 10_000

_MICROSECOND = dt.timedelta(microseconds=1)


def _parse_instant(text: str, name: str, up: bool = False) -> dt.datetime:
    if not re.match(RFC3339_LOOSE.replace(r"\z", r"\Z"), text, re.ASCII):
        raise ValueError(f"invalid {name}: {text!r}")
    clock = re.sub(r"T(\d):", r"T0\1:", text.replace(",", "."))
    local = dt.datetime.fromisoformat(re.sub(r"(\.\d{1,6})\d*", r"\1", re.sub(r"(Z|[+-]\d\d:\d\d)$", "", clock))) \
        if _is_date(clock) else None
    if local is None:
        raise ValueError(f"invalid {name}: {text!r}")
    offset = dt.timedelta()
    if not text.endswith("Z"):
        offset = dt.timedelta(hours=int(text[-5:-3]), minutes=int(text[-2:]))
        offset = -offset if text[-6] == "-" else offset
    instant = (local - offset).replace(tzinfo=dt.timezone.utc)
    # Stored times are whole microseconds: the first that is not before a finer start is the next.
    cut = re.search(r"\.\d{6}(\d*)", clock)
    return instant + _MICROSECOND if up and cut and cut[1].strip("0") else instant


def _is_date(clock: str) -> bool:
    try:
        dt.datetime.fromisoformat(clock[:19])
    except ValueError:
        return False
    return True


def resolve_window(
    start_time: str | None = None, end_time: str | None = None
) -> tuple[dt.datetime, dt.datetime]:
    """Both ends of a window from optional RFC 3339 texts; empty texts count as absent."""
    start = _parse_instant(start_time or WINDOW_START, "start_time", up=True)
    end = _parse_instant(end_time or WINDOW_END, "end_time")
    if start > end:
        raise ValueError("start_time must be before or equal to end_time")
    return start, end


def in_time_window(df: DataFrame, start: Column | dt.datetime, end: Column | dt.datetime) -> DataFrame:
    """Rows with ``start <= timestamp <= end``; tables with a day column are pruned by it."""
    inside = F.col("timestamp").between(F.lit(start), F.lit(end))
    if EVENT_DATE in df.columns:
        inside = inside & F.col(EVENT_DATE).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    return df.filter(inside)


def list_gpus(telemetry: DataFrame) -> DataFrame:
    """The distinct GPU ids in order, of the rows that have one."""
    return telemetry.filter("uuid IS NOT NULL").select("uuid").distinct().orderBy("uuid")


def gpu_telemetry(
    telemetry: DataFrame,
    uuid: str | Column,
    start_time: str | None = None,
    end_time: str | None = None,
) -> DataFrame:
    """One GPU's entries in a time window, by time ascending."""
    start, end = resolve_window(start_time, end_time)
    wanted = telemetry.filter(F.col("uuid") == F.lit(uuid))
    return in_time_window(wanted, start, end).select(*ENTRY_COLUMNS).orderBy("timestamp")


def gpus_response(telemetry: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``gpus``, an ordered array of ``{id}``, in pages; one empty page when there are none."""
    known = telemetry.filter("uuid IS NOT NULL").select("uuid")
    item = F.struct(F.col("uuid").alias("id"))
    cut = pages(known.distinct(), [], ["uuid"], item, page_size, "gpus")
    none = known.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        F.lit(0).cast("bigint").alias("page"), F.array().cast("array<struct<id:string>>").alias("gpus")
    )
    return cut.unionByName(none)


def telemetry_response(
    telemetry: DataFrame,
    requested: DataFrame | list[str],
    start_time: str | None = None,
    end_time: str | None = None,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """``{gpu_id, entries}`` for every ``gpu_id`` of ``requested``, entries by time, in pages.

    A list of ids is a filter of the scan; a table of them, as large as you like, a join.
    ``gpu_id`` echoes the requested id, which is looked up as ``uuid``. A GPU without rows in
    the window gets one page with no entries. Equal times are ordered by the row ``id``.
    """
    start, end = resolve_window(start_time, end_time)
    rows = in_time_window(telemetry, start, end)
    if isinstance(requested, list):
        ids = sorted(set(requested))
        asked = telemetry.sparkSession.createDataFrame([(i,) for i in ids], "gpu_id string")
        rows = rows.filter(F.col("uuid").isin(ids))
    else:
        asked = requested.select("gpu_id").distinct()
        rows = rows.join(asked.select(F.col("gpu_id").alias("uuid")), "uuid", "left_semi")
    entry = F.struct(*ENTRY_COLUMNS)
    keyed = rows.withColumns({"_entry": entry, "_gpu": F.col("uuid")}).select(
        "_gpu", "timestamp", "id", "_entry"
    )
    cut = pages(keyed, ["_gpu"], ["timestamp", "id"], F.col("_entry"), page_size, "entries")
    kind = cut.schema["entries"].dataType
    seen = rows.select(F.col("uuid").alias("gpu_id")).distinct().withColumn("_seen", F.lit(True))
    none = asked.join(seen, "gpu_id", "left").filter("_seen IS NULL").select(
        "gpu_id", F.lit(0).cast("bigint").alias("page"), F.array().cast(kind).alias("entries")
    )
    # No join of pages: those of one GPU stay spread over the tasks that cut them.
    return cut.withColumnRenamed("_gpu", "gpu_id").unionByName(none)
