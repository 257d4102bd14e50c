import datetime as dt

from pyspark.sql import functions as F

from gaugeline.operators import readings
from gaugeline.schemas import TELEMETRY_SCHEMA
from gaugeline.sources import files, gpu_days
from gaugeline.sources.gpu_days import GpuDays
from gaugeline.sources.tables import append_telemetry, scan_telemetry

T0 = dt.datetime(2025, 6, 1, 12, tzinfo=dt.timezone.utc)
DAY = dt.date(2025, 6, 1)


def rows(spark, *wanted):
    """(uuid, days after T0, or None for no time)"""
    made = [
        (i, u, str(i), "0", "m", None if d is None else T0 + dt.timedelta(days=d), *[None] * 6, 1.0, None, T0)
        for i, (u, d) in enumerate(wanted)
    ]
    return spark.createDataFrame(made, TELEMETRY_SCHEMA)


def state(df):
    return sorted((r.uuid, r.readings, r.first_at, r.last_at) for r in df.collect())


def brute(spark, path):
    seen = {}
    for r in scan_telemetry(spark, path).select("uuid", F.col("timestamp").alias("t")).collect():
        if r.uuid is not None:
            seen.setdefault(r.uuid, []).append(r.t)
    known = {u: [t for t in ts if t is not None] for u, ts in seen.items()}
    return sorted((u, len(seen[u]), min(ts, default=None), max(ts, default=None)) for u, ts in known.items())


def test_absent_and_empty_tables(spark, tmp_path):
    for path in (str(tmp_path / "none"), str(tmp_path / "empty")):
        if path.endswith("empty"):
            append_telemetry(rows(spark, ("A", 0)).filter("false"), path)
        days = GpuDays(spark, path)
        assert days.close() == [] and days.gpus().count() == 0 and days.closed() == set()
        assert [(r.page, r.gpus) for r in readings.gpus_response(days.gpus()).collect()] == [(0, [])]


def test_summaries_late_readings_and_rows_without_gpu_or_time(spark, tmp_path):
    path = str(tmp_path / "t")
    append_telemetry(rows(spark, ("A", 0), ("A", 0), (None, 0), ("B", 1), ("C", 2)), path)
    days = GpuDays(spark, path)
    assert state(days.gpus()) == brute(spark, path)
    assert days.close(DAY + dt.timedelta(days=2)) == [DAY, DAY + dt.timedelta(days=1)]
    assert days.closed() == {DAY, DAY + dt.timedelta(days=1)} and state(days.gpus()) == brute(spark, path)
    # A late reading outdates its day only, until that is closed again.
    append_telemetry(rows(spark, ("D", 0), ("E", None)).withColumn("id", F.col("id") + 100).filter("uuid = 'D'"), path)
    assert days.closed() == {DAY + dt.timedelta(days=1)} and state(days.gpus()) == brute(spark, path)
    assert days.close() == [DAY, DAY + dt.timedelta(days=2)] and days.close() == []
    assert state(days.gpus()) == brute(spark, path)
    assert [r.uuid for r in readings.list_gpus(days.gpus()).collect()] == ["A", "B", "C", "D"]


def test_readings_without_time_are_always_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_telemetry(rows(spark, ("A", 0), ("E", None)), path)
    days = GpuDays(spark, path)
    days.close()
    assert days.closed() == {DAY} and [u for u, *_ in state(days.gpus())] == ["A", "E"]


def test_closed_days_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_telemetry(rows(spark, *[(f"G{i}", i % 5) for i in range(50)]), path)
    days = GpuDays(spark, path)
    days.close(DAY + dt.timedelta(days=4))
    open_day = f"event_date={DAY + dt.timedelta(days=4)}"
    frame = days.by_day()
    found = frame._jdf.queryExecution().optimizedPlan().toString()
    assert found.count("Relation") == 2
    scans = [s for s in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in s and f"{path}]" in s]
    assert len(scans) == 1 and "PartitionFilters" in scans[0]
    # Files of closed days may be spoilt: nobody opens them.
    for name in files.names(spark, path):
        if name != open_day:
            for part in files.names(spark, f"{path}/{name}"):
                (tmp_path / "t" / name / part).write_bytes(b"not parquet")
                (tmp_path / "t" / name / f".{part}.crc").unlink(missing_ok=True)
    assert [u for u, *_ in state(days.gpus())] == sorted(f"G{i}" for i in range(50))


def test_unfinished_jobs_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    append_telemetry(rows(spark, ("A", 0), ("B", 1)), path)
    days = GpuDays(spark, path)
    days.close()
    take = days._takes()[0]
    files.remove(spark, f"{days.path}/{take}/_SUCCESS")
    assert days.closed() == set() and [u for u, *_ in state(days.gpus())] == ["A", "B"]
    assert len(days.close()) == 2


def test_many_jobs_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(gpu_days, "TAKES", 2)
    path = str(tmp_path / "t")
    days = GpuDays(spark, path)
    for i in range(4):
        append_telemetry(rows(spark, (f"G{i}", i % 3)).withColumn("id", F.lit(i).cast("long")), path)
        days.close()
        assert len(days._takes()) <= 2
        assert len(days.closed()) == len(days.present())
    assert state(days.gpus()) == brute(spark, path)
