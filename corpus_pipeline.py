"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs.  All but the last return the columns
of ``documents``; the last returns the packed pieces.

1. language: the predicted language becomes ``lang``; documents without a language
   (null text or no letter) go; where no row is labelled, ``lang`` stays as it is;
2. lines: later copies of repeated line runs are deleted and ``n_chars`` follows;
   documents that lose their whole text go;
3. near copies: one document of each component of 5-word-shingle similarity 0.8 stays
   (the smallest id, then text; rows that repeat its id and text stay too);
4. benchmark: documents that hold a benchmark item go;
5. packing: pieces of the remaining documents in full power-of-two windows.

Null and empty inputs: see the operators.  Columns beyond those of ``documents`` pass
through stages 1 to 4.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lapforge.llm import decontamination, language, line_dedup, ngram_join, packing  # noqa: E402
from lapforge.llm.common import read_table, small_batches, written  # noqa: E402

NEAR_WORDS, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1 (operator 9)."""
    small_batches(spark)
    return language.with_language(docs, language.samples(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2 (operator 2)."""
    small_batches(spark)
    out = line_dedup.dedup_lines(docs)
    left = F.length(F.trim(F.regexp_replace("text", r"\s+", " ")))
    return out.where((F.col("lines_removed") == 0) | (left > 0)).select(
        *(F.when(F.col("lines_removed") > 0, F.length("text").cast(docs.schema[c].dataType))
          .otherwise(F.col(c)).alias(c) if c == "n_chars" else c for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3 (operator 3)."""
    small_batches(spark)
    return ngram_join.keep_one(docs, NEAR_WORDS, NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4 (operator 7)."""
    small_batches(spark)
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5 (operator 1)."""
    import public_tokenizers

    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near copies", drop_near_copies),
    ("benchmark", decontaminate),
    ("packing", pack),
]

# Suffix automata and the tokenizer have no SQL form; tests hold run() against
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
