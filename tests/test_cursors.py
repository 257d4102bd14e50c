"""Cursors: passed messages are not read, marks only rise, and counting an insert does not shuffle the table."""

from pyspark.sql import functions as F

from gaugeline.operators import cursors, merge, queue
from gaugeline.plans import adapters
from gaugeline.sources import files, tables

SF = "/root/testdata/sf0.001"


def scanned(spark, df):
    """Rows that leave the scans of a query, by its metrics after it ran."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        found = [leaves.apply(i) for i in range(leaves.size())]
        return sum(p.metrics().apply("numOutputRows").value() for p in found if "FileScan" in p.toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_passed_ranges_are_not_read(spark, tmp_path):
    stored = str(tmp_path / "q")
    rows = adapters.queue(adapters.load(spark, SF))
    for flush in range(10):
        tables.append_queue(rows.filter(F.col("id").between(flush * 100, flush * 100 + 99)).coalesce(1), stored, str(flush))
    ranges = queue.partition_ranges(spark, 4)
    marks = spark.createDataFrame([(o, 899) for o in range(4)], cursors.CURSORS)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scan = tables.scan_queue(spark, stored).filter(cursors.not_passed(ranges, marks))
    # A flush is one row group with ids of its own: only the last one's are opened.
    assert scanned(spark, scan.select("id")) <= 100 < scanned(spark, tables.scan_queue(spark, stored).select("id"))
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,899)" in text and "GreaterThanOrEqual(partition_key,64)" in text
    got = cursors.fetch_after_cursor(tables.scan_queue(spark, stored), ranges, marks, 7).collect()
    want = queue.fetch_batch_per_owner(rows.filter("id > 899"), ranges, 7).collect()
    assert sorted(got) == sorted(want) and got


def test_marks_follow_deletes_and_only_rise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cursors, "SAVED", 3)
    path, rows = str(tmp_path / "c"), adapters.queue(adapters.load(spark, SF))
    ranges = queue.partition_ranges(spark, 2)
    assert cursors.read_cursors(spark, path).count() == 0
    first = {r.owner: r.mark for r in cursors.passed_marks(rows, ranges).collect()}
    left = queue.assign_owner(rows, ranges).filter("NOT (owner = 1 AND id < 500)")
    for some in (rows, left, rows, rows, rows):
        cursors.save_cursors(cursors.passed_marks(some.select("id", "partition_key"), ranges), path)
    marks = {r.owner: r.mark for r in cursors.read_cursors(spark, path).collect()}
    assert marks[0] == first[0] and marks[1] >= 499 > first[1]
    assert len([n for n in files.names(spark, path)]) <= 3
    # Nothing that is left is passed by.
    ahead = cursors.fetch_after_cursor(left.drop("owner"), ranges, cursors.read_cursors(spark, path), 10_000)
    assert sorted((r.owner, r.id) for r in ahead.collect()) == sorted((r.owner, r.id) for r in left.collect())


def test_overlapping_ranges_and_no_owners(spark):
    rows = adapters.queue(adapters.load(spark, SF)).filter("id < 40")
    ranges = spark.createDataFrame([(0, 0, 255), (1, 0, 255), (2, 9, 3)], "owner int, start int, end int")
    marks = spark.createDataFrame([(0, 29)], cursors.CURSORS)
    got = cursors.fetch_after_cursor(rows, ranges, marks, 5).collect()
    assert sorted((r.owner, r.id) for r in got) == [(0, i) for i in range(30, 35)] + [(1, i) for i in range(5)]
    assert cursors.fetch_after_cursor(rows, ranges.filter("owner = 2"), marks).count() == 0


def test_counting_an_insert_does_not_shuffle_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("k")).write.parquet(path)
    spark.createDataFrame([("t", "5"), ("t", "5"), ("t", "x"), ("u", "5")], "topic string, k string").write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    counts = merge.insert_counts(spark.read.parquet(path), batch, ["topic", "k"], "topic", "accepted")
    assert sorted(map(tuple, counts.collect())) == [("t", 1, 2), ("u", 1, 0)]
    lines = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    # The table's scan goes into the broadcast join with the batch before any exchange.
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and f"{path}]" in x)
    join = next(i for i in range(at, -1, -1) if "LeftSemi" in lines[i])
    assert "BroadcastHashJoin" in lines[join] and not any("Exchange" in x for x in lines[join:at])
