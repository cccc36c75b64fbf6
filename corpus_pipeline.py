"""Cleaning of a document corpus in stages, each a call of one text operator.

Defined results, for every stage: null text counts as empty; a null doc_id is an id like others, and rows are
told apart by id and text; the filtering stages leave rows as they are, with all their columns, whatever
these are called; rows that repeat share their fate, of which the two dedup stages leave one; of
equal texts the largest doc_id stays, of near ones the smallest; an empty table gives an empty one.
The last stage gives one row of digests for every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridsieve.llm import chunks, decontam, pieces, resample, simhash
from gridsieve.llm.common import keep, rows_where

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws stay."""
    return resample.drawn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: that with the largest doc_id."""
    return rows_where(docs, chunks.exact_duplicates(docs).where("kept"), present=True, single=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints stays: that with the smallest doc_id."""
    return rows_where(docs, simhash.near_duplicates(docs).where("kept"), present=True, single=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return rows_where(docs, decontam.contaminated(docs, benchmark), present=False)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document that is left."""
    return pieces.digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

# Hashing with XXH64, models and tokenizers are beyond SQL; tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
