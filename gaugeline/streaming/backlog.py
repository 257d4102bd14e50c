"""The backlog of every partition kept as a running count, so that asking for it reads no queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.sources import files

COUNTS = "partition_key int, waiting bigint"


def running_backlog(inserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """(partition_key, waiting) of streams or tables of messages put on the queue and deleted from it, each once.

    Every message counts one up or down. Counts are combined in each task before they are shuffled, and the state is one number per partition.
    """
    up = inserts.select("partition_key", F.lit(1).alias("n"))
    down = deletes.select("partition_key", F.lit(-1).alias("n"))
    return up.unionByName(down).groupBy("partition_key").agg(F.sum("n").cast("bigint").alias("waiting"))


def backlog_stream(inserts: DataFrame, deletes: DataFrame, path: str, checkpoint: str, trigger: str = "1 second",
                   available_now: bool = False) -> StreamingQuery:
    """Keep the running backlog in a folder: one small file for the last batch, and the one before it while that is written."""
    def store(counts: DataFrame, batch: int) -> None:
        spark = counts.sparkSession
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")
        for name in files.names(spark, path):
            if int(name.split("=")[1]) < batch - 1:
                files.remove(spark, f"{path.rstrip('/')}/{name}")

    writer = running_backlog(inserts, deletes).writeStream.outputMode("complete").foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def stored_backlog(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the last complete batch; none before the first."""
    folders = [f"{path.rstrip('/')}/{n}" for n in files.names(spark, path)]
    whole = [f for f in folders if files.exists(spark, f"{f}/_SUCCESS")]
    if not whole:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(max(whole, key=lambda f: int(f.rsplit("=", 1)[1])))
