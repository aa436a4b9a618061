"""The corpus pipeline: stages over documents, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantframe.llm import exact_dedup, importance, jaccard_join, mixing, packing
from plantframe.llm.common import bound_batches, staged
from plantframe.llm.queries import ship, table, tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the well labelled ones rejects go."""
    bound_batches(spark)
    return importance.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar word shingles stays."""
    bound_batches(spark)
    return jaccard_join.drop_similar(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document occurs at least once; documents of small sources up to twice."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in sequences."""
    bound_batches(spark)
    return packing.pack_documents(docs, tokenizer())


STAGES = [("quality", quality), ("exact dedup", exact), ("near duplicates", near), ("mixing", mixed), ("packing", packed)]
#: Tokenizing, sampling and packing are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
