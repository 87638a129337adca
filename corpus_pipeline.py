"""From documents to packed training sequences, stage by stage.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame, which is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerfold.llm import line_dedup, near_dup, packing, quality
from ledgerfold.llm.common import table
from ledgerfold.sources.scratch import written


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects. It learns from the labels of all
    documents of the table, as they are, that are not held out."""
    model = quality.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that resemble an earlier line; a document that loses all its lines stays,
    with an empty text."""
    return line_dedup.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group that SimHash links."""
    return near_dup.keep_first(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", accept_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]

# SQL expresses neither trees nor tokenizers; tests hold every stage against a plain program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
