"""Cleaning a corpus for training: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes the documents its predecessor kept and returns documents (the last one:
packed pieces).  Stages are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topiclens.llm.line_dedup import without_repeated_lines
from topiclens.llm.packing import pack_documents
from topiclens.llm.quality_rules import clean_documents
from topiclens.llm.queries import tokenizer_path
from topiclens.llm.simhash_dedup import keep_first
from topiclens.llm.source_mixing import mixed_documents
from topiclens.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go; documents that are rejected go."""
    return clean_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-equal lines one stays; documents keep their other lines."""
    return without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return keep_first(docs, shingle=3, max_bits=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: repeated, whole, in part or not at all."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer_path(), max_len=4096, end_id=2)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_dedup", near_copies),
    ("source_mixing", mixture),
    ("packing", packed),
]

#: Hash signatures, components and tokenizer ids have no form in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the packed pieces of the cleaned and mixed corpus.

    Null, empty and blank texts go in the first stage; null ids and repeated rows are rows like any other, extra
    columns are carried to the last stage whatever their names, and an empty table gives no pieces.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
