"""Fetching after a cursor: owners go on where all before them is done, and passed messages are not read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.queue import MESSAGE_COLUMNS, assign_owner
from gaugeline.operators.ranking import first_per_group
from gaugeline.schemas import FETCH_LIMIT
from gaugeline.sources import files

CURSORS = "owner int, mark bigint"
SAVED = 64  # files of cursors after which they are written anew


def passed_marks(queue: DataFrame, ranges: DataFrame) -> DataFrame:
    """(owner, mark): the highest id before every message that the owner still has; owners without messages have no row.

    Ids rise, so nothing at or below the mark comes back. Only the id and partition columns are read.
    """
    owned = assign_owner(queue.select("id", "partition_key"), ranges)
    return owned.groupBy("owner").agg((F.min("id") - 1).alias("mark"))


def save_cursors(marks: DataFrame, path: str) -> None:
    """Store marks of some owners; one that is lower than a stored one changes nothing. One writer at a time."""
    spark = marks.sparkSession
    old = files.names(spark, path)
    if len(old) >= SAVED:
        marks = marks.select("owner", "mark").unionByName(read_cursors(spark, path)).groupBy("owner").agg(F.max("mark").alias("mark"))
    marks.select(F.col("owner").cast("int"), F.col("mark").cast("bigint")).coalesce(1).write.mode("append").parquet(path)
    if len(old) >= SAVED:
        for name in old:
            files.remove(spark, f"{path.rstrip('/')}/{name}")


def read_cursors(spark: SparkSession, path: str) -> DataFrame:
    """The highest mark stored for each owner; none if nothing is stored."""
    if not files.names(spark, path):
        return spark.createDataFrame([], CURSORS)
    return spark.read.schema(CURSORS).parquet(path).groupBy("owner").agg(F.max("mark").alias("mark"))


def not_passed(ranges: DataFrame, cursors: DataFrame) -> Column:
    """A condition on partition_key and id that the scan can check against the bounds of row groups.

    Its terms are constants: one range of partitions and one mark per owner, of which there are at most as many as partitions.
    """
    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    known = ranges.filter(start <= end).join(cursors, "owner", "left").select(start.alias("s"), end.alias("e"), "mark")
    terms = []
    for r in sorted(known.collect(), key=lambda r: (r.s, r.e, -1 if r.mark is None else r.mark)):
        own = (F.col("partition_key") >= r.s) & (F.col("partition_key") <= r.e)
        terms.append(own if r.mark is None else own & (F.col("id") > r.mark))
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def fetch_after_cursor(queue: DataFrame, ranges: DataFrame, cursors: DataFrame, limit: int = FETCH_LIMIT) -> DataFrame:
    """The oldest ``limit`` messages of every owner after its mark; an owner without one starts at the front.

    Queue files are sorted by (partition_key, id), so row groups of passed messages are skipped by their bounds.
    """
    owned = assign_owner(queue.filter(not_passed(ranges, cursors)), ranges)
    # Where ranges overlap, a row may be after the mark of one of its owners only.
    ahead = owned.join(cursors.withColumnRenamed("mark", "_mark"), "owner", "left").filter("_mark IS NULL OR id > _mark")
    return first_per_group(ahead.select("owner", *MESSAGE_COLUMNS), ["owner"], "id", limit)
