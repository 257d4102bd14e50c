import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import readings
from gaugeline.schemas import ENTRY_COLUMNS, TELEMETRY_SCHEMA

T0 = dt.datetime(2025, 6, 1, 12, 0, 0, tzinfo=dt.timezone.utc)


def telemetry(spark, *rows):
    """(uuid, seconds after T0)"""
    made = [
        (i, u, str(i), "0", "m", T0 + dt.timedelta(seconds=s), None, None, None, None, None, None, 1.0, None, T0)
        for i, (u, s) in enumerate(rows)
    ]
    return spark.createDataFrame(made, TELEMETRY_SCHEMA)


def window(spark, start, end):
    rows = telemetry(spark, *[("GPU-A", s) for s in (0, 10, 20, 30, 60)], ("GPU-B", 10))

    def text(seconds):
        return (T0 + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ") if seconds is not None else None

    return readings.gpu_telemetry(rows, "GPU-A", text(start), text(end))


@pytest.mark.parametrize("start, end, n", [
    (-3600, 3600, 5), (0, 20, 3), (60, 7200, 1), (10, 30, 3), (7200, 10800, 0),
    (None, None, 5), (10, None, 4), (None, 10, 2),
])
def test_windows_include_both_ends(spark, start, end, n):
    df = window(spark, start, end)
    assert df.columns == ENTRY_COLUMNS and df.count() == n


def test_order(spark):
    rows = telemetry(spark, ("G", 1800), ("G", 0), ("G", 900))
    times = [r.timestamp for r in readings.gpu_telemetry(rows, "G").collect()]
    assert times == sorted(times)


@pytest.mark.parametrize("start, end, message", [
    ("not-a-time", None, "invalid start_time"), (None, "nope", "invalid end_time"),
    ("2025-02-30T00:00:00Z", None, "invalid start_time"),
    ("2030-01-01T00:00:00Z", "2020-01-01T00:00:00Z", "start_time must be before or equal to end_time"),
])
def test_bad_windows(start, end, message):
    with pytest.raises(ValueError, match=message):
        readings.resolve_window(start, end)


def test_resolve_window():
    utc = dt.timezone.utc
    assert readings.resolve_window() == (dt.datetime(1970, 1, 1, tzinfo=utc), dt.datetime(2100, 1, 1, tzinfo=utc))
    start, end = readings.resolve_window("2026-01-01T05:30:00.5+05:30", "2026-01-01T00:00:00,500000999Z")
    assert start == end == dt.datetime(2026, 1, 1, 0, 0, 0, 500000, tzinfo=utc)


def test_list_gpus(spark):
    rows = telemetry(spark, ("GPU-BBB", 0), ("GPU-AAA", 0), ("GPU-AAA", 1), (None, 2))
    assert [r.uuid for r in readings.list_gpus(rows).collect()] == ["GPU-AAA", "GPU-BBB"]
    answer = readings.gpus_response(rows).collect()
    assert [[g.id for g in r.gpus] for r in answer] == [["GPU-AAA", "GPU-BBB"]]
    assert [(r.page, r.gpus) for r in readings.gpus_response(rows.filter("false")).collect()] == [(0, [])]


def test_response(spark):
    rows = telemetry(spark, ("A", 30), ("A", 10), ("A", 10), ("B", 5))
    asked = spark.createDataFrame([("A",), ("none",)], "gpu_id string")
    got = {r.gpu_id: [e.timestamp for e in r.entries] for r in readings.telemetry_response(rows, asked).collect()}
    assert got["none"] == [] and len(got["A"]) == 3 and got["A"] == sorted(got["A"])
    assert set(got) == {"A", "none"}
    listed = readings.telemetry_response(rows, ["A", "none"])
    assert {r.gpu_id: len(r.entries) for r in listed.collect()} == {"A": 3, "none": 0}


def test_response_of_a_hot_gpu_in_pages(spark):
    rows = spark.range(5000).select(
        F.col("id"), F.lit("HOT").alias("uuid"), F.expr("concat('u', id)").alias("msg_uuid"),
        F.lit("0").alias("gpu_id"), F.lit("m").alias("metric_name"),
        F.timestamp_seconds(F.col("id") * 7919 % 100).alias("timestamp"),
        *[F.lit(None).cast(TELEMETRY_SCHEMA[c].dataType).alias(c) for c in TELEMETRY_SCHEMA.names[6:]],
    )
    asked = spark.createDataFrame([("HOT",)], "gpu_id string")
    for tasks in (1, 7):
        got = readings.telemetry_response(rows.repartition(tasks), asked, page_size=64).orderBy("page").collect()
        times = [e.timestamp for r in got for e in r.entries]
        assert len(times) == 5000 and times == sorted(times)
        assert [r.page for r in got] == list(range(79))
        assert {len(r.entries) for r in got[:-1]} == {64} and len(got[-1].entries) == 8


def test_window_ends_finer_than_a_microsecond():
    start, end = readings.resolve_window("2026-01-01T00:00:00.000000001Z", "2026-01-01T00:00:00.000001999Z")
    assert (start.microsecond, end.microsecond) == (1, 1)
    assert readings.resolve_window("2026-01-01T00:00:00.000000000Z")[0].microsecond == 0
