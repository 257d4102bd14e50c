"""Connected components of large graphs, and cutting large groups into pairs of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b: numbers) that has a neighbour: root is its component's least.

    Large-star and small-star steps alternate until every vertex hangs on its component's least vertex; each round
    is written to the shared folder. Stars are joined with one least value per vertex, so that a
    vertex with many neighbours is an ordinary skewed join. Nothing is gathered.
    """
    step = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges")
    mark = _signature(step)
    while True:
        both = step.unionByName(step.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.withColumnRenamed("m", "b")).distinct()
        )
        step = saved(small, "edges")
        before, mark = mark, _signature(step)
        if mark == before:
            break
    return step.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(
        step.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).head()
    return tuple(row)


def part_pairs(rows: DataFrame, key: str, identity: str, most: int) -> DataFrame:
    """Cut groups of over ``most`` rows into parts, and send each row to every pair of parts that has its own.

    Adds part, first, second: rows that share key, first and second form a group of at most about 2 x ``most``
    rows, and any two rows of a key meet in exactly one group in which they are in different parts, or in the one with
    first = second that is their part's own.
    """
    large = rows.groupBy(key).count().where(F.col("count") > most)
    parts = large.select(key, F.ceil(F.col("count") / most).cast("int").alias("parts"))
    dealt = (
        rows.join(parts, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64(identity), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    return dealt.withColumn("first", F.least("part", "other")).withColumn("second", F.greatest("part", "other")).drop("parts", "other")
