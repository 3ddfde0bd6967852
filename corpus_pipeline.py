"""From raw documents to packed sequences: five stages, each over all that the one before kept.

Every stage is written and read again, so a lost executor repeats work of one stage at
most.  ``run`` gives the packed pieces of the surviving documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estatelake.llm import cutting_stock, line_alignment, mixing, one_permutation, weak_labels
from estatelake.llm.queries import vocabulary
from estatelake.staging import stage

KEY, TEXT = "doc_id", "text"
# Near duplicates: words of a shingle, and the least similarity as a fraction.
SHINGLE_WORDS, LEAST_SIMILARITY = 5, (80, 100)


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go, and those without words."""
    return weak_labels.good_rows(docs, KEY, TEXT)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; documents of which no word is left go too."""
    return line_alignment.without_shared_lines(docs, KEY, TEXT)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_permutation.one_of_each_group(docs, KEY, TEXT, SHINGLE_WORDS, LEAST_SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by code point weigh 1, 2, 3, repeating; documents come as often as the mix takes them."""
    return mixing.take(docs, mixing.mix(docs), KEY)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2,048 tokens."""
    return cutting_stock.pack(docs, vocabulary(), KEY, TEXT)


STAGES = [
    ("quality classifier", keep_good_texts),
    ("line dedup", drop_shared_lines),
    ("near duplicates", keep_one_of_each_group),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]
# Expectation-maximisation, alignment and linear programs have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
