"""The queue and telemetry tables as parquet folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.schemas import QUEUE_COLUMNS, QUEUE_SCHEMA, TELEMETRY_COLUMNS, TELEMETRY_SCHEMA
from gaugeline.sources import files
from gaugeline.sources.files import move as _move
from gaugeline.sources.files import remove
from gaugeline.sources.keys import KeyTable

EVENT_DATE = "event_date"
INGEST_BATCH = "ingest_batch"
REWRITE, NEXT_ID, KEYS = "_rewrite", "_next_id", "_keys"  # below a table, where scans do not look
# Parquet's Bloom filters of uuid, as large as a file's ids need: an id that a file lacks is not looked for in it, though it lies
# between the file's least and greatest.
ID_FILTER = {"parquet.bloom.filter.enabled#uuid": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
MARKS = 64  # files of highest ids after which they are written anew


def _with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything Spark would read."""
    return bool(files.names(spark, path))


def batch_complete(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether an ingest batch was written to its end."""
    return files.exists(spark, f"{path.rstrip('/')}/{INGEST_BATCH}={batch}/_SUCCESS")


def queue_keys(spark: SparkSession, path: str) -> KeyTable:
    """The message ids of a stored queue, with the ingest batch of each."""
    return KeyTable(spark, f"{path.rstrip('/')}/{KEYS}", ["topic", "msg_uuid"])


def telemetry_keys(spark: SparkSession, path: str) -> KeyTable:
    """The message ids of a stored telemetry table."""
    return KeyTable(spark, f"{path.rstrip('/')}/{KEYS}", ["msg_uuid"])


def scan_queue(spark: SparkSession, path: str) -> DataFrame:
    """All queued messages; an absent table is empty."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], QUEUE_SCHEMA)
    schema = _with_field(QUEUE_SCHEMA, INGEST_BATCH, T.StringType())
    return spark.read.schema(schema).parquet(path).select(*QUEUE_COLUMNS)


def scan_batches(spark: SparkSession, path: str, batches: list[str] | None) -> DataFrame:
    """The messages of some ingest batches, of all for None; no folder of another is read."""
    schema = _with_field(QUEUE_SCHEMA, INGEST_BATCH, T.StringType())
    stored = spark.read.schema(schema).parquet(path)
    return stored if batches is None else stored.filter(F.col(INGEST_BATCH).isin(batches))


def next_id(spark: SparkSession, path: str) -> int:
    """One more than the greatest message id that the queue has or ever had: a stored mark, or all file footers where none is."""
    marks = f"{path.rstrip('/')}/{NEXT_ID}"
    if table_exists(spark, marks):
        return spark.read.schema("id bigint").parquet(marks).agg(F.max("id")).head()[0] + 1
    greatest = scan_queue(spark, path).agg(F.max("id")).head()[0]
    return 0 if greatest is None else greatest + 1


def raise_mark(spark: SparkSession, path: str, last: int) -> None:
    """Remember that ids up to ``last`` are given. A few small files, which are replaced by one now and then."""
    marks = f"{path.rstrip('/')}/{NEXT_ID}"
    old = files.names(spark, marks)
    spark.range(last, last + 1, 1, 1).write.mode("append").parquet(marks)
    if len(old) >= MARKS:
        for name in old:
            remove(spark, f"{marks}/{name}")


def reserve_ids(spark: SparkSession, path: str, n: int) -> int:
    """The first of ``n`` ids that no message has or will have. The work does not depend on the length of the queue."""
    first = next_id(spark, path)
    if n:
        raise_mark(spark, path, first + n - 1)
    return first


def delete_from_queue(spark: SparkSession, path: str, done: DataFrame) -> None:
    """Delete the messages whose ``id`` is in ``done`` from the stored queue; other ids do not matter.

    Only the ingest batches that hold such messages are rewritten, all in one job; of the others no more than
    the ids are read. A batch that is rewritten stays known as published. A delete that was broken off has done
    nothing, or is finished by the next delete or publish. Streams of the queue get the messages that
    stay in rewritten batches once more. Like publishing, a job for one writer at a time.
    """
    finish_delete(spark, path)
    if not table_exists(spark, path):
        return
    path = path.rstrip("/")
    stored = spark.read.schema(_with_field(QUEUE_SCHEMA, INGEST_BATCH, T.StringType())).parquet(path)
    gone = done.select("id")
    hit = stored.select("id", INGEST_BATCH).join(gone, "id", "left_semi").select(INGEST_BATCH).distinct()
    names = [r[0] for r in hit.collect()]  # of folders, which the driver lists at any scan
    if not names:
        return
    # Ids of deleted messages are not given again.
    raise_mark(spark, path, next_id(spark, path) - 1)
    (
        stored.filter(F.col(INGEST_BATCH).isin(names)).join(gone, "id", "left_anti")
        .select(*QUEUE_COLUMNS, INGEST_BATCH)
        .repartitionByRange(INGEST_BATCH, "partition_key", "id")
        .sortWithinPartitions(INGEST_BATCH, "partition_key", "id")
        .write.mode("overwrite").partitionBy(INGEST_BATCH).parquet(f"{path}/{REWRITE}/rows")
    )
    for name in names:
        files.touch(spark, f"{path}/{REWRITE}/rows/{INGEST_BATCH}={name}/_SUCCESS")
    spark.createDataFrame([(n,) for n in names], "name string").write.mode("overwrite").parquet(
        f"{path}/{REWRITE}/names")
    finish_delete(spark, path)


def finish_delete(spark: SparkSession, path: str) -> None:
    """Put the rewritten batches of a complete delete into their places; nothing if there is none."""
    top = f"{path.rstrip('/')}/{REWRITE}"
    if not files.exists(spark, f"{top}/names/_SUCCESS"):
        return
    for row in spark.read.parquet(f"{top}/names").collect():
        folder = f"{INGEST_BATCH}={row.name}"
        if files.exists(spark, f"{top}/rows/{folder}"):
            remove(spark, f"{path.rstrip('/')}/{folder}")
            _move(spark, f"{top}/rows/{folder}", f"{path.rstrip('/')}/{folder}")
    remove(spark, top)


def stream_queue(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The queue table as a stream of the messages appended to it.

    Files that a delete replaces before they are read are passed over: what stays of them comes in new files.
    """
    reader = spark.readStream.schema(_with_field(QUEUE_SCHEMA, INGEST_BATCH, T.StringType()))
    reader = reader.option("ignoreMissingFiles", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*QUEUE_COLUMNS)


def append_queue(df: DataFrame, path: str, batch: str, replace: bool = False, keyed: bool = False) -> None:
    """Add messages under the folder of an ingest batch.

    Sorting each task's rows, without a shuffle, gives row groups narrow (partition_key, id)
    ranges for partition reads to skip by. ``replace`` is for batches whose replay has to
    take the place of an unfinished attempt. Unless the writer keeps the stored mark and key table itself (``keyed``),
    they are brought up to date, the latter by building it anew when it is wanted next.
    """
    folder = f"{path.rstrip('/')}/{INGEST_BATCH}={batch}"
    spark = df.sparkSession
    (
        df.select(*QUEUE_COLUMNS).sortWithinPartitions("partition_key", "id")
        .write.mode("overwrite" if replace else "append").parquet(folder)
    )
    if not keyed:
        remove(spark, f"{path.rstrip('/')}/{KEYS}")
        last = spark.read.schema(QUEUE_SCHEMA).parquet(folder).agg(F.max("id")).head()[0]
        if table_exists(spark, f"{path.rstrip('/')}/{NEXT_ID}") and last is not None and last >= next_id(spark, path):
            raise_mark(spark, path, last)


def append_telemetry(df: DataFrame, path: str, at: Column | None = None, keyed: bool = False) -> None:
    """Append telemetry rows by day; ``ingested_at`` is ``at`` or now where it is not set.

    Rows are range-partitioned by (day, uuid, timestamp): a GPU with very many rows spreads
    over several tasks, and a lookup by uuid and time skips most files and row groups; Bloom filters skip those that only could
    have the id. Unless the writer keeps the table's
    key table itself (``keyed``), that is built anew when it is wanted next.
    """
    if not keyed:
        remove(df.sparkSession, f"{path.rstrip('/')}/{KEYS}")
    now = at if at is not None else F.current_timestamp()
    has_time = "ingested_at" in df.columns
    stamped = df.withColumn("ingested_at", F.coalesce(F.col("ingested_at"), now) if has_time else now)
    rows = stamped.select(*TELEMETRY_COLUMNS, F.to_date("timestamp").alias(EVENT_DATE))
    (
        rows.repartitionByRange(EVENT_DATE, "uuid", "timestamp")
        .sortWithinPartitions(EVENT_DATE, "uuid", "timestamp")
        .write.mode("append").options(**ID_FILTER).partitionBy(EVENT_DATE).parquet(path)
    )


def scan_telemetry(
    spark: SparkSession, path: str, days: list[dt.date] | None = None
) -> DataFrame:
    """All telemetry rows with their day, or those of some days; an absent table is empty."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], _with_field(TELEMETRY_SCHEMA, EVENT_DATE, T.DateType()))
    schema = _with_field(TELEMETRY_SCHEMA, EVENT_DATE, T.DateType())
    table = spark.read.schema(schema).parquet(path)
    return table if days is None else table.filter(F.col(EVENT_DATE).isin(days))
