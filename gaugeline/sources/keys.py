"""Key tables: the keys of a stored table, dealt into buckets by hash, for inserts that do not read the table.

A row is a key and the name of the batch that brought it. Rows lie in folders by bucket, so a batch is
compared with the buckets its own keys fall into and with nothing else. Keys of small batches go to one file of a
log, which every lookup reads too; once it has ``LOG_FILES`` files they are dealt into the buckets. A table of too many
files is written anew as its next generation, which counts once it is complete. Copies of rows do no harm, so whatever is broken
off can be done again. Like the tables themselves, key tables have one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.sources import files

BUCKETS, LOG = 256, -1
#: Keys up to which a batch goes to the log, files that the log may have, files that a bucket may have on average.
LOG_KEYS, LOG_FILES, BUCKET_FILES = 50_000, 64, 16
BUCKET, BATCH, GENERATION, PENDING = "bucket", "batch", "generation", "_pending"


class KeyTable:
    """The keys of one stored table, in a folder below it where scans of the table do not look."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def _generation(self) -> int | None:
        names = [n for n in files.names(self.spark, self.path) if n.startswith(f"{GENERATION}=")]
        whole = [int(n.split("=")[1]) for n in names if files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return max(whole, default=None)

    def _folder(self, generation: int) -> str:
        return f"{self.path}/{GENERATION}={generation}"

    def exists(self) -> bool:
        return self._generation() is not None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def scan(self) -> DataFrame:
        """All rows: the keys, their batch and their bucket."""
        fields = [T.StructField(k, T.StringType()) for k in [*self.keys, BATCH]]
        schema = T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])
        generation = self._generation()
        if generation is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._folder(generation))

    def _write(self, rows: DataFrame, generation: int, mode: str) -> None:
        """Add rows that have a bucket: one file for each bucket, sorted, so that row groups have narrow key ranges."""
        (
            rows.select(*self.keys, BATCH, BUCKET).repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys)
            .write.mode(mode).partitionBy(BUCKET).parquet(self._folder(generation))
        )

    def build(self, table: DataFrame) -> None:
        """Start anew with the keys of a whole table."""
        files.remove(self.spark, self.path)
        self._write(table.select(*self.keys).withColumn(BATCH, F.lit("")).withColumn(BUCKET, self.bucket()), 0, "overwrite")

    def held(self, rows: DataFrame) -> DataFrame:
        """The stored rows with a key of ``rows``. Only the log and the buckets of those keys are read.

        The numbers of the buckets, 256 at most, go to the driver, so that the scan has them as a partition filter.
        """
        buckets = [r[0] for r in rows.select(self.bucket()).distinct().collect()]
        stored = self.scan().filter(F.col(BUCKET).isin([LOG, *buckets]))
        return stored.join(rows.select(*self.keys), self.keys, "left_semi").select(*self.keys, BATCH)

    def append(self, rows: DataFrame, batch: str, size: int) -> None:
        """Add the keys of ``rows``, which a batch brings and of which there are at most ``size``."""
        new = rows.select(*self.keys).withColumn(BATCH, F.lit(batch))
        generation = self._generation() or 0
        if size > LOG_KEYS:
            self._write(new.withColumn(BUCKET, self.bucket()), generation, "append")
        else:
            new.withColumn(BUCKET, F.lit(LOG)).coalesce(1).write.mode("append").partitionBy(BUCKET).parquet(self._folder(generation))
        self.tidy()

    def tidy(self) -> None:
        """Deal a long log into the buckets; write a table of too many files anew."""
        generation = self._generation()
        top = self._folder(generation)
        log = f"{top}/{BUCKET}={LOG}"
        if len(files.names(self.spark, log)) <= LOG_FILES:
            return
        if files.count(self.spark, top) > BUCKETS * BUCKET_FILES:
            self._write(self.scan().distinct().withColumn(BUCKET, self.bucket()), generation + 1, "overwrite")
            files.remove(self.spark, top)
            return
        self._write(self.scan().filter(F.col(BUCKET) == LOG).withColumn(BUCKET, self.bucket()), generation, "append")
        files.remove(self.spark, log)

    # Between the keys and the rows of a batch a writer may be lost; what is pending is looked up in the table itself.

    def begin(self, batch: str) -> None:
        files.touch(self.spark, f"{self.path}/{PENDING}/{batch}")

    def end(self, batch: str) -> None:
        files.remove(self.spark, f"{self.path}/{PENDING}/{batch}")

    def pending(self) -> list[str]:
        """Batches whose keys may be here without their rows."""
        return files.names(self.spark, f"{self.path}/{PENDING}")
