"""What the operators of this folder share: tables, scratch tables, files and word counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import work_folder

#: A word is a run of anything but the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The pyarrow file system of a folder that all executors share, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in small slices, so that what Python holds at once stays small."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def publish(store: fs.FileSystem, written: str, final: str) -> None:
    """Give a finished file its name. Attempts of one task write the same bytes, so the last wins."""
    store.move(written, final)
