"""The corpus pipeline: quality, toxicity, near-duplicates, mixing and packing, one after another.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return documents with
their own columns; the last returns pieces of packed token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import mixing, packing, quality, simhash, toxicity
from gaugeline.llm.common import load, saved


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.keep_civil(docs, load(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens, with their ids."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("simhash", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned models, fingerprints and tokenizers are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written as Parquet and read again for the next stage."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
