"""Partition hashing and message ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.schemas import VIRTUAL_PARTITIONS

# FNV-1a, 32 bit.
FNV_OFFSET = 2166136261
FNV_PRIME = 16777619
FNV_MASK = 4294967295

_HEX_GROUPS = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


def fnv1a32(c: Column) -> Column:
    """FNV-1a over the UTF-8 bytes, folded inside the JVM.

    Ids are nearly always ASCII, where characters are the bytes; other texts go through
    their hexadecimal bytes. Empty text is apart because splitting it leaves one element.
    """
    start = F.lit(FNV_OFFSET).cast("long")

    def step(h: Column, byte: Column) -> Column:
        return (h.bitwiseXOR(byte.cast("long")) * F.lit(FNV_PRIME).cast("long")).bitwiseAND(
            F.lit(FNV_MASK).cast("long")
        )

    ascii_hash = F.aggregate(F.split(c, ""), start, lambda h, ch: step(h, F.ascii(ch)))
    byte_texts = F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit("(..)"), F.lit(1))
    byte_hash = F.aggregate(byte_texts, start, lambda h, x: step(h, F.conv(x, 16, 10)))
    return (
        F.when(F.octet_length(c) == 0, start)
        .when(F.octet_length(c) == F.char_length(c), ascii_hash)
        .when(c.isNotNull(), byte_hash)
    )


def fnv1a_partition(c: Column, n: int = VIRTUAL_PARTITIONS) -> Column:
    return F.pmod(fnv1a32(c), F.lit(n).cast("long")).cast("int")


def shape_uuid(hex32: Column) -> Column:
    """32 hexadecimal digits as 8-4-4-4-12."""
    return F.concat_ws(
        "-",
        F.substring(hex32, 1, 8), F.substring(hex32, 9, 4), F.substring(hex32, 13, 4),
        F.substring(hex32, 17, 4), F.substring(hex32, 21, 12),
    )


def keyed_uuid(keys: list[Column], namespace: str = "telemetry") -> Column:
    """An id that is the same whenever the source keys are the same, and different for any others.

    Of several keys each is preceded by its length, so that no two lists of keys give one text.
    """
    parts = [F.coalesce(k.cast("string"), F.lit("\x00")) for k in keys]
    if len(parts) > 1:
        parts = [F.concat(F.length(p).cast("string"), F.lit("#"), p) for p in parts]
    return shape_uuid(F.md5(F.concat_ws(":", F.lit(namespace), *parts)))


def assign_msg_uuid(
    df: DataFrame, keys: list[str] | None = None, namespace: str = "telemetry"
) -> DataFrame:
    """Give every message its ``msg_uuid``.

    Without ``keys`` the id is random, as for newly received messages; write such rows once
    before using them twice. With ``keys`` a replay gives the same ids again.
    """
    made = keyed_uuid([F.col(k) for k in keys], namespace) if keys else F.uuid()
    return df.withColumn("msg_uuid", made)


def canonical_uuid(c: Column) -> Column:
    """Plain, ``urn:uuid:``, wrapped or 32-digit UUID text to lower-case 8-4-4-4-12, else NULL."""
    plain = F.when(c.rlike(rf"^{_HEX_GROUPS}\z"), c)
    urn = F.when(c.rlike(rf"^(?i:urn:uuid:){_HEX_GROUPS}\z"), F.substring(c, 10, 36))
    wrapped = F.when(c.rlike(rf"^\p{{ASCII}}{_HEX_GROUPS}\p{{ASCII}}\z"), F.substring(c, 2, 36))
    bare = F.when(c.rlike(r"^[0-9a-fA-F]{32}\z"), shape_uuid(c))
    return F.lower(F.coalesce(plain, urn, wrapped, bare))
