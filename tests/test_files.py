import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.plans import adapters
from gaugeline.sources import csv_files, tables

HEADER = ("timestamp,metric_name,gpu_id,device,uuid,model_name,hostname,container,pod,namespace,"
          "value,labels_raw\n")
RECORDS = (
    '2026-01-01T00:00:00Z,m,0,nv0,GPU-1,A100,h,c,p,ns,1.5,"a=""b"",c\nd"\n'
    "\n"
    "2026-01-01T00:00:00Z, m ,0,nv0,GPU-2,A100,h,,,,x,\n"
    'bad,m,0,nv0,GPU-3,A100,h,c,p,ns,1.5,l,EXTRA,"q,r"\n'
    'bad,m,0,nv0,GPU-4,A100,h,c,p,ns,"1,5"\n'
    'bad,m,0,nv0,  "GPU-5,x",A100,h,c,p,ns,2,z\n'
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEADER + RECORDS)
    return str(tmp_path / "in")


def test_positional_read(spark, folder):
    df = csv_files.read_telemetry_csv(spark, folder)
    rows = {r.uuid: r for r in df.collect()}
    assert set(rows) == {"GPU-1", "GPU-2", "GPU-3", "GPU-5,x"}
    assert rows["GPU-1"].labels_raw == 'a="b",c\nd' and rows["GPU-1"].value == 1.5
    assert rows["GPU-2"].metric_name == "m" and rows["GPU-2"].value == 0.0 and rows["GPU-2"].pod == ""
    assert rows["GPU-3"].labels_raw == "l" and rows["GPU-3"].timestamp is None
    assert df.count() == df.select("uuid").count() == 4


def test_rejected(spark, folder):
    rows = csv_files.read_rejected_csv(spark, folder).collect()
    assert [(r.fields, "GPU-4" in r.record) for r in rows] == [(11, True)]


def test_strict(spark, folder, tmp_path):
    with pytest.raises(Exception, match="expected 12 fields"):
        csv_files.read_telemetry_csv(spark, folder, mode="strict").collect()
    (tmp_path / "empty.csv").write_text(HEADER)
    assert csv_files.read_telemetry_csv(spark, str(tmp_path / "empty.csv")).count() == 0
    with pytest.raises(ValueError, match="no data rows"):
        csv_files.read_telemetry_csv(spark, str(tmp_path / "empty.csv"), mode="strict")


def test_many_quotes_in_a_flagged_record(spark, tmp_path):
    """A field of very many quotes is counted without deep recursion."""
    field = '"' + '""' * 200_000 + '"'
    (tmp_path / "q.csv").write_text(HEADER + f"t,m,0,d,GPU-1,A,h,c,p,n,1,{field},more\n")
    row = csv_files.read_telemetry_csv(spark, str(tmp_path / "q.csv")).first()
    assert row.labels_raw == '"' * 200_000


def test_write_and_read_again(spark, folder, tmp_path):
    df = csv_files.read_telemetry_csv(spark, folder)
    out = str(tmp_path / "out")
    csv_files.write_telemetry_csv(df, out)
    back = csv_files.read_telemetry_csv(spark, out, mode="strict")
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text.startswith(HEADER) and ",GPU-2,A100,h,,,,0,\n" in text


def test_by_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "Value,labelsRaw,TIMESTAMP,metricName,gpuId,device,UUID,modelName,host_name,container,pod,namespace,more\n"
        "1.5,l,2026-01-01T00:00:00Z,m,0,nv0,GPU-1,A100,h,c,p,ns,e\n"
        "1.5,l,2026-01-01T00:00:00Z,m,0,nv0,GPU-2,A100,h,c,p,ns\n"
    )
    row = csv_files.read_telemetry_csv(spark, str(tmp_path / "h.csv"), by_header=True).collect()
    assert [(r.uuid, r.value, r.hostname) for r in row] == [("GPU-1", 1.5, "h")]
    (tmp_path / "short.csv").write_text("value,uuid\n1,GPU-1\n")
    with pytest.raises(ValueError, match="missing from the header"):
        csv_files.read_telemetry_csv(spark, str(tmp_path / "short.csv"), by_header=True)


def test_stream(spark, folder, tmp_path):
    query = (
        csv_files.stream_telemetry_csv(spark, folder, 1).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
        .start(str(tmp_path / "o"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 4


def test_telemetry_table_prunes_days(spark, tmp_path):
    events = adapters.load(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "telemetry")
    tables.append_telemetry(adapters.telemetry(events), path)
    assert tables.scan_telemetry(spark, path).count() == events.count()
    day = tables.scan_telemetry(spark, path, [dt.date(2024, 1, 5)])
    assert day.count() == events.filter("to_date(ts) = '2024-01-05'").count() > 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_absent_tables_are_empty(spark, tmp_path):
    assert tables.scan_queue(spark, str(tmp_path / "no")).count() == 0
    assert tables.scan_telemetry(spark, str(tmp_path / "no")).count() == 0


def test_ingested_at_defaults_to_now(spark, tmp_path):
    rows = adapters.telemetry(adapters.load(spark, "/root/testdata/sf0.001")).drop("ingested_at")
    tables.append_telemetry(rows, str(tmp_path / "t"))
    assert tables.scan_telemetry(spark, str(tmp_path / "t")).filter(F.col("ingested_at").isNull()).isEmpty()


def test_absent_ids_are_not_looked_for(spark, tmp_path):
    """An id between a file's least and greatest, which its dictionary does not rule out, is ruled out by the Bloom filter."""
    events = adapters.load(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "t")
    rows = adapters.telemetry(events).withColumn("uuid", F.concat(F.lit("GPU-"), F.md5(F.col("id").cast("string"))))
    tables.append_telemetry(rows.coalesce(1), path)
    known = rows.filter("id = 77").head().uuid

    def scanned(uuid, bloom):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            reader = spark.read.option("parquet.filter.bloom.enabled", bloom).option("parquet.filter.dictionary.enabled", "false")
            df = reader.option("parquet.filter.columnindex.enabled", "false").parquet(path).filter(F.col("uuid") == uuid).select("uuid", "value")
            found = len(df.collect())
            leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
            return found, leaves.apply(0).metrics().apply("numOutputRows").value()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")

    absent = known[:-1] + ("0" if known[-1] != "0" else "1")
    found, read = scanned(absent, "false")
    assert found == 0 and read > 0
    found, skipping = scanned(absent, "true")
    assert found == 0 and skipping < read
    assert scanned(known, "true")[0] == scanned(known, "false")[0] == 1
