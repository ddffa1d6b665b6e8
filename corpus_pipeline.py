"""The corpus pipeline: documents -> packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prefkit.llm import exact_dedup, jaccard_join, mixing, packing, quality
from prefkit.llm.common import written
from prefkit.llm.queries import tokenizer_file
from prefkit.sources.bindings import table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality ranking does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (the largest doc_id)."""
    return exact_dedup.drop_duplicates(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: five-word shingles, Jaccard 0.8 or more."""
    return jaccard_join.drop_similar(docs, width=5, num=4, den=5)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (weights 5, 2, 1 in turn, at most 3 epochs); a
    document that is taken twice is two rows, one that is not taken goes."""
    return mixing.repeated(docs, weights=(5.0, 2.0, 1.0), share=1.0, max_epochs=3)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2,048 tokens."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), length=2048)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_deduplication),
    ("n-gram Jaccard join", near_deduplication),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", sequence_packing),
]

#: The learned ranking, the seeded sample and the token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline{i}")
    return docs
