"""Splitting labelled rows and drawing the bounded sample that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """(y, t): label and whole text of at most ``rows`` labelled documents, those with the least hash of their key.

    ``learn`` is a condition on the column k, the key. Labels other than 0 and 1 and null keys are left out; a
    key with several labels counts with its least one, and its documents all count.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)")
    some = known.where(learn).groupBy("k").agg(F.min("y").alias("y")).orderBy(F.xxhash64("k"), "k").limit(rows)
    texts = docs.select(F.col(key).alias("dk"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    return texts.join(some, F.col("dk") == F.col("k")).select("y", "t")
