"""Which GPUs a stored telemetry table has, by day, so that the list is not read from the readings again and again.

A summary of a day has one row per GPU: how many readings it has that day, the first and the last. Telemetry is only ever
added to, so a day that has as many files as when it was summarised has not changed; the number is part of the summary's
folder. Other days, late readings included, are read from the table, and summaries of one GPU merge by sums and extremes.
Days are counted before they are read: what comes in between makes a summary outdated, never short.
"""

from __future__ import annotations

import datetime as dt
import uuid as uuids
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.sources import files
from gaugeline.sources.tables import EVENT_DATE, scan_telemetry

FOLDER, TAKE, FILES = "_gpus", "take", "files"  # below the table, where scans do not look
TAKES = 32  # jobs whose summaries are kept apart
SUMMARY = T.StructType([
    T.StructField("uuid", T.StringType()), T.StructField("readings", T.LongType()),
    T.StructField("first_at", T.TimestampType()), T.StructField("last_at", T.TimestampType()),
])


class GpuDays:
    """The summaries of one stored telemetry table. One process at a time may close days; any number may read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table, self.path = spark, path.rstrip("/"), f"{path.rstrip('/')}/{FOLDER}"

    def present(self) -> dict[dt.date, int]:
        """How many files each day of the table has. Readings without a time have no day and are never summarised."""
        prefix = f"{EVENT_DATE}="
        days = [n.removeprefix(prefix) for n in files.names(self.spark, self.table) if n.startswith(prefix)]
        return {
            dt.date.fromisoformat(d): len(files.names(self.spark, f"{self.table}/{prefix}{d}"))
            for d in days if not d.startswith("__")
        }

    def _takes(self) -> list[str]:
        """The jobs that came to their end."""
        names = [n for n in files.names(self.spark, self.path) if n.startswith(f"{TAKE}=")]
        return [n for n in names if files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]

    def _stored(self) -> dict[str, dict[dt.date, int]]:
        """The days that each job has summarised, with the number of files they had."""
        out: dict[str, dict[dt.date, int]] = {}
        for take in self._takes():
            top = f"{self.path}/{take}"
            out[take] = {
                dt.date.fromisoformat(day.split("=")[1]): int(held.split("=")[1])
                for day in files.names(self.spark, top) for held in files.names(self.spark, f"{top}/{day}")
            }
        return out

    def closed(self) -> set[dt.date]:
        """The days whose summary is up to date."""
        return set(self._current()[1])

    def _current(self) -> tuple[dict[dt.date, int], dict[dt.date, str]]:
        """Files per day of the table, and for days that did not change the job whose summary stands for them."""
        stored, present = self._stored(), self.present()
        return present, {d: take for take, days in stored.items() for d, n in days.items() if present.get(d) == n}

    def _scan(self, takes: dict[dt.date, str]) -> DataFrame:
        """The summaries of some days, each from its own job; no other folder is read."""
        schema = T.StructType([*SUMMARY, T.StructField(EVENT_DATE, T.DateType()), T.StructField(FILES, T.IntegerType())])
        parts = []
        for take in sorted(set(takes.values())):
            days = sorted(d for d, t in takes.items() if t == take)
            read = self.spark.read.schema(schema).parquet(f"{self.path}/{take}")
            parts.append(read.filter(F.col(EVENT_DATE).isin(days)))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame) -> None:
        """One job: summaries by day and number of files. A day of very many GPUs may take several tasks."""
        (
            rows.repartitionByRange(EVENT_DATE, "uuid").sortWithinPartitions(EVENT_DATE, "uuid")
            .write.partitionBy(EVENT_DATE, FILES).parquet(f"{self.path}/{TAKE}={uuids.uuid4().hex}")
        )

    def close(self, before: dt.date | None = None) -> list[dt.date]:
        """Summarise the days before a day, or all, that have no summary or got readings since; gives these days.

        A day without any GPU has no summary and is looked at each time. Broken off, this leaves the summaries as
        they were.
        """
        present, takes = self._current()
        days = sorted(d for d in present if d not in takes and (before is None or d < before))
        if days:
            counted = F.create_map(*[F.lit(x) for d in days for x in (d, present[d])])
            found = daily_gpus(scan_telemetry(self.spark, self.table, days))
            self._write(found.withColumn(FILES, counted[F.col(EVENT_DATE)]))
            self.tidy()
        return days

    def tidy(self) -> None:
        """Put the summaries of many jobs together; outdated ones go."""
        old = self._takes()
        if len(old) <= TAKES:
            return
        self._write(self._scan(self._current()[1]))
        for take in old:
            files.remove(self.spark, f"{self.path}/{take}")

    def by_day(self) -> DataFrame:
        """One row per day and GPU: ``event_date``, ``uuid``, ``readings``, ``first_at``, ``last_at``.

        Days whose summary is up to date come from it, all others from their readings.
        """
        _, takes = self._current()
        table = scan_telemetry(self.spark, self.table)
        if takes:
            table = table.filter(F.col(EVENT_DATE).isNull() | ~F.col(EVENT_DATE).isin(sorted(takes)))
        return self._scan(takes).drop(FILES).unionByName(daily_gpus(table))

    def gpus(self) -> DataFrame:
        """One row per GPU, over all days: ``uuid``, ``readings``, ``first_at``, ``last_at``."""
        return merged_gpus(self.by_day())


def daily_gpus(telemetry: DataFrame) -> DataFrame:
    """Readings to one row per day and GPU, of the rows that have a GPU."""
    return telemetry.filter("uuid IS NOT NULL").groupBy(EVENT_DATE, "uuid").agg(
        F.count(F.lit(1)).alias("readings"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at"))


def merged_gpus(days: DataFrame) -> DataFrame:
    """Summaries of days to one row per GPU."""
    return days.groupBy("uuid").agg(
        F.sum("readings").alias("readings"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
