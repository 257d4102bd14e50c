"""CSV files cut in parallel give the records of reading them from front to end."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline.plans import catalog
from gaugeline.sources import csv_files, csv_splits, files
from gaugeline.schemas import READING_COLUMNS

HEADER = ",".join(READING_COLUMNS)


def records_by_letters(text):
    """Records of a text, one character after another; a quote opens a field only in front of it."""
    out, now, state = [], "", "start"
    for c in text.replace("\r\n", "\n"):
        if c == "\n" and state != "quoted":
            out.append(now)
            now, state = "", "start"
            continue
        now += c
        if state == "quoted":
            state = "closed?" if c == '"' else "quoted"
        elif state == "closed?" and c == '"':
            state = "quoted"
        elif c == ",":
            state = "start"
        elif state == "start" and c == '"':
            state = "quoted"
        elif state == "start" and c in " \t":
            pass
        else:
            state = "after" if state in ("closed?", "after") else "bare"
    return [r for r in [*out, now] if r]


@settings(max_examples=500, deadline=None)
@given(text=st.text(st.sampled_from('",a \n'), max_size=40))
def test_states_of_lines(text):
    lines = text.split("\n")
    inside, now, got = False, [], []
    for line in lines:
        inside = csv_splits.ends_inside(line, inside)
        now.append(line)
        if not inside:
            got.append("\n".join(now))
            now = []
    assert [r for r in [*got, "\n".join(now)] if r] == records_by_letters(text)


def made(seed, n):
    rng = random.Random(seed)
    def field():
        kind = rng.random()
        if kind < 0.5:
            return rng.choice(["", "a", "12", "x y", "5 o\'clock"])
        if kind < 0.6:
            return 'bare " quote'
        body = "".join(rng.choice(["a", ",", "\n", '""', "\n\n", "é", " "]) for _ in range(rng.randint(0, 30)))
        return f' "{body}"' if kind < 0.65 else f'"{body}"'
    return [",".join(field() for _ in range(12)) for _ in range(n)]


@pytest.mark.parametrize("size", [100, 5000])
def test_records_of_any_split(spark, tmp_path, size):
    files = {f"{i}.csv": [HEADER, *made(i, 12 if i else 3), *([] if i else ['"' + "long\n" * 600 + '"' + "," * 11])] for i in range(3)}
    for name, records in files.items():
        (tmp_path / name).write_text("\n".join(records) + ("\n" if name != "1.csv" else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = csv_splits.lines_of(spark, str(tmp_path))
        assert size == 5000 or lines.select("file", "start").distinct().count() > 12
        got = sorted(r.record for r in csv_splits.csv_records(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [r for name in files for r in records_by_letters((tmp_path / name).read_text())[1:]]
    assert got == sorted(want)


def test_split_reading_is_reading(spark, tmp_path):
    rows = [r for r in made(9, 150) if "bare" not in r]
    (tmp_path / "a.csv").write_text("\r\n".join([HEADER, *rows, "too,short", ""]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        split = csv_files.read_telemetry_csv(spark, str(tmp_path), multi_line="split")
        whole = csv_files.read_telemetry_csv(spark, str(tmp_path))
        assert split.count() == whole.count() > 30
        assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()
        bad = csv_files.read_rejected_csv(spark, str(tmp_path), multi_line="split").collect()
        assert [(r.record, r.fields) for r in bad] == [("too,short", 2)]
        with pytest.raises(Exception, match="expected 12 fields"):
            csv_files.read_telemetry_csv(spark, str(tmp_path), mode="strict", multi_line="split").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_nothing_and_headers_only(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text(HEADER)
    assert csv_files.read_telemetry_csv(spark, str(tmp_path), multi_line="split").count() == 0


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from('",a \né'), max_size=60), inside=st.booleans())
def test_lines_at_once_are_lines_one_by_one(text, inside):
    lines = text.split("\n")
    now, want = inside, []
    for line in lines:
        now = csv_splits.ends_inside(line, now)
        want.append(not now)
    ends, last = csv_splits.record_ends(csv_splits.turns_of(pa.array(lines)), inside)
    assert (ends.tolist(), last) == (want, now)


def events(spark, folder, n, parts):
    """Rows like the given events in several files."""
    spark.range(0, n, 1, parts).selectExpr(
        "id AS event_id", "cast(timestamp_seconds(1704067200 + id) AS timestamp_ntz) AS ts", "id % 9 AS user_id", "'view' AS event_type",
        "id / 4.0D AS value", "'{\"k\": 1}' AS props").write.parquet(f"{folder}/events.parquet")


def test_csv_rejects_is_read_by_several_tasks(spark, tmp_path):
    events(spark, tmp_path, 4000, 4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    spark.conf.set("spark.sql.files.openCostInBytes", "60000")  # a file or split to a task
    try:
        found = catalog.QUERIES["csv_rejects"](spark, str(tmp_path))
        tasks = found.select(F.spark_partition_id().alias("p"), "record").groupBy("p").agg(F.count("*").alias("n")).collect()
        assert sum(t.n for t in tasks) == 572 and len(tasks) > 4
        assert sorted(int(r.record.split(",")[0]) for r in found.collect()) == list(range(0, 4000, 7))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_split_has_a_bounded_number_of_splits(spark, tmp_path, monkeypatch):
    events(spark, tmp_path, 500, 1)
    sizes, usual = [], csv_files.read_telemetry_csv

    def read(session, *args, **kwargs):
        sizes.append(int(session.conf.get("spark.sql.files.maxPartitionBytes")))
        return usual(session, *args, **kwargs)

    monkeypatch.setattr(csv_files, "read_telemetry_csv", read)
    assert catalog.QUERIES["csv_split"](spark, str(tmp_path)).count() == 500
    monkeypatch.setattr(files, "size", lambda *_: 6 << 30)
    assert catalog.QUERIES["csv_split"](spark, str(tmp_path)).count() == 500
    assert sizes[0] == 64 << 10 and (6 << 30) // sizes[1] <= 400
