"""Corpus pipeline: documents through quality rules, line deduplication, near
deduplication, benchmark decontamination and SentencePiece encoding.

Every stage takes all documents that the one before it has kept; between stages
they are written as Parquet in the shared folder and read again, so a lost
executor costs a stage's tasks, never the stages before.  All stages but the last
return the columns of ``documents``, the last one the encoding.

Rows: a null or empty text fails the quality rules and goes.  A row with a null id is
cleaned like any other, loses lines to documents with ids, and is never dropped as a
near-copy.  Rows that repeat an id stay as long as their texts are no near-copies.  Texts
of any length are processed whole.  Extra columns, whatever their names, come along up to
the fourth stage; ``n_chars`` follows the text.  Of near-copies with equal ids one stays.
An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.contamination import uncontaminated
from tidemark.llm.linededup import without_repeated_lines
from tidemark.llm.neardup import without_near_copies
from tidemark.llm.pieces import encode_pieces
from tidemark.llm.quality import cleaned
from tidemark.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed; documents that fail or lose too much go."""
    return cleaned(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id has are removed."""
    return without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, similarity 0.8."""
    return without_near_copies(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a test item go."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as piece ids."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Near-duplicates and merge-dropout aren't expressible in SQL; tests hold run()
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_dir(spark, "pipeline-" + name.split()[0].lower())
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
