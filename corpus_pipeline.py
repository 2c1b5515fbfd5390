"""From raw documents to packed context windows: five stages, each one operator over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm.common import store
from rowtide.llm.mixing import repeated_documents
from rowtide.llm.packing import pack
from rowtide.llm.quality_ranker import keep_good
from rowtide.llm.simhash_dedup import keep_one
from rowtide.llm.substring_dedup import cleaned_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranker rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    return keep_one(docs, shingle=3, reach=2)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that a document with a smaller doc_id has are taken out of the texts."""
    return cleaned_documents(docs, size=13)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return repeated_documents(docs, weights=(3, 1, 2), share=1.5, most=2)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its words, the context window it goes to, and where in it. Copies of a document never share one.

    The pieces of a ``bin_id`` by ``position`` are the text of that window, and
    those of a ``row_id``, which tells the copies of a document apart, by
    ``start`` that copy: the rows are the corpus.
    """
    # Mixing cuts a copy, which is no longer equal to the others: the id tells whose copy it is.
    return pack(docs, capacity=2048, same=docs["doc_id"], with_words=True)


STAGES = [
    ("quality", quality),
    ("simhash", simhash),
    ("substrings", substrings),
    ("mixing", mixing),
    ("packing", packing),
]

# A model is trained, fingerprints are hashed with XXH64 and bins are filled one after another:
# no SQL for the rows of run(). The tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
