"""Small documents with everything that can be odd about them, and the given tables."""

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

ROWS = [
    (5, "one two three four five six", "b", 1),
    (5, "one two three four five six", "b", 1),  # a repeated row
    (6, "One TWO three four five six", "b", 2),
    (7, None, "a", 3),
    (8, "", "a", 4),
    (20, " spaced  out\n\ttext   end ", None, 5),
    (40, "naïve été ñ 日本語 <|endoftext|> <|startoftext|> it's 12.5%", "c", 6),
    (60, "word " * 6000 + "▁last", "c", 7),
    (None, "no key at all here today", None, None),
    (80, "x" * 5000, "a", 9),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like those that operators add."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("size", T.LongType())])
    df = spark.createDataFrame(ROWS, schema)
    for name in ("fp", "h", "k", "target", "taken", "score", "group", "n_tokens", "length", "count"):
        df = df.withColumn(name, df["size"])
    return df.repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
