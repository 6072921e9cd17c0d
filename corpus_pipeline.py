"""From raw documents to packed sequences: language, quality, near duplicates, packing.

Each stage takes what its predecessor kept, written as Parquet and read again. All stages but the last return rows of
``documents`` with their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import language, near_duplicates, packing, quality, tables


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the others teach; texts that are null, without letters or like none of them go."""
    return language.keep_known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not isolated by the forest."""
    return quality.keep_good(docs, tables.read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 or more."""
    return near_duplicates.keep_first(docs, size=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near duplicates", one_of_each),
    ("packing", packed),
]

# Trained networks and forests, and tokenizers, are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
