"""Moving queue and telemetry tables between schema versions 1 and 7."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.identity import canonical_uuid, fnv1a_partition
from gaugeline.functions.payload import extract_gpu_id
from gaugeline.schemas import VIRTUAL_PARTITIONS

LATEST = 7

# The columns version 4 drops from the queue, and their defaults.
LEASE_STATE_COLUMNS = ["state", "leased_by", "lease_id", "lease_until", "attempts", "updated_at"]


def _must(df: DataFrame, ok: Column, message: str) -> DataFrame:
    """The rows, or a failed job where ``ok`` does not hold for one, whatever columns are read."""
    failure = F.raise_error(F.lit(message)).cast("string")
    return df.filter(F.when(~F.coalesce(ok, F.lit(False)), failure).isNull())


def upgrade_telemetry(df: DataFrame, from_version: int, to_version: int = LATEST) -> DataFrame:
    """v3 adds device and hostname, v5 adds msg_uuid from uuid, v6 makes uuid text."""
    nothing = F.lit(None).cast("string")
    if from_version < 3 <= to_version:
        df = df.withColumns({"device": nothing, "hostname": nothing})
    if from_version < 5 <= to_version:
        old = F.col("msg_uuid") if "msg_uuid" in df.columns else nothing
        filled = F.coalesce(old, F.col("uuid").cast("string"))
        df = _must(df, filled.isNotNull(), "msg_uuid is missing").withColumn("msg_uuid", filled)
    if from_version < 6 <= to_version:
        df = df.withColumn("uuid", F.col("uuid").cast("string"))
    return df


def downgrade_telemetry(df: DataFrame, from_version: int, to_version: int) -> DataFrame:
    """The reverse; going below v6 fails on a uuid that is not a UUID."""
    if from_version >= 6 > to_version:
        uuid = canonical_uuid(F.col("uuid"))
        ok = F.col("uuid").isNull() | uuid.isNotNull()
        df = _must(df, ok, "uuid is not a UUID").withColumn("uuid", uuid)
    if from_version >= 5 > to_version:
        df = df.drop("msg_uuid")
    if from_version >= 3 > to_version:
        df = df.drop("device", "hostname")
    return df


def upgrade_queue(
    df: DataFrame, from_version: int, to_version: int = LATEST, rehash: bool = False
) -> DataFrame:
    """v2 adds partition_key, 0 for old rows or hashed from their payload; v4 drops lease state."""
    if from_version < 2 <= to_version:
        key = F.lit(0)
        if rehash:
            gpu_id = F.coalesce(extract_gpu_id("payload"), F.lit(""))
            key = fnv1a_partition(gpu_id, VIRTUAL_PARTITIONS)
        df = df.withColumn("partition_key", key)
    if from_version < 4 <= to_version:
        df = df.drop(*LEASE_STATE_COLUMNS)
    return df


def downgrade_queue(
    df: DataFrame, from_version: int, to_version: int, at: Column | None = None
) -> DataFrame:
    """The reverse; lease state comes back as for messages never served."""
    if from_version >= 4 > to_version:
        df = df.withColumns({
            "state": F.lit("ready"),
            "leased_by": F.lit(None).cast("string"),
            "lease_id": F.lit(None).cast("string"),
            "lease_until": F.lit(None).cast("timestamp"),
            "attempts": F.lit(0),
            "updated_at": at if at is not None else F.current_timestamp(),
        })
    if from_version >= 2 > to_version:
        df = df.drop("partition_key")
    return df
