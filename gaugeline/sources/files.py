"""Looking at and removing files and folders, wherever Spark keeps them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """The file system of a path, and the path as that knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = located(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder that a reader would see; none if there is no such folder."""
    fs, where = located(spark, path)
    if not fs.exists(where):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n for n in found if not n.startswith(("_", ".")))


def count(spark: SparkSession, path: str) -> int:
    """How many files there are in a folder and below."""
    fs, where = located(spark, path)
    return fs.getContentSummary(where).getFileCount() if fs.exists(where) else 0


def size(spark: SparkSession, path: str) -> int:
    """How many bytes there are in a folder and below."""
    fs, where = located(spark, path)
    return fs.getContentSummary(where).getLength() if fs.exists(where) else 0


def touch(spark: SparkSession, path: str) -> None:
    fs, where = located(spark, path)
    fs.create(where, True).close()


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, where = located(spark, path)
    if not fs.rename(where, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot move {path} to {to}")


def remove(spark: SparkSession, path: str) -> None:
    fs, where = located(spark, path)
    fs.delete(where, True)
