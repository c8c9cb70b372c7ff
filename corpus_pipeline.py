"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame, which :func:`run` writes as Parquet to the shared
folder and rereads as the next stage's ``docs``; a stage's intermediates go once its result is written.  All stages but the last
return the columns of ``documents``.  Each drops what its operator decides
against and nothing else; null texts, empty texts and extra columns pass
through unless a stage rejects the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import common, decontaminate, exact_dedup, packing, quality, simhash
from strata.llm.tokenise import word_vocabulary


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranker rejects go; it learns from the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep(docs, quality.learn(docs, labels, "quality", folds=5, cut=0.3))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.deduplicate(docs, shingle=3, radius=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.decontaminate(docs, items, window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that is left, each with its place in a sequence of 4,096 tokens."""
    return packing.pack(docs, word_vocabulary(), capacity=4096, end_id=1)


STAGES = [("quality", good), ("exact dedup", exact), ("near dedup", near), ("decontamination", benchmark),
          ("packing", pack)]

# scores, fingerprints and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    start = common.scratch_mark(spark)
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        common.clear_scratch(spark, start, keep=1)  # what led to the stage's result
    return docs
