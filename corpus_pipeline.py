"""The corpus pipeline: language ID, near-duplicates, decontamination, packing.

Each stage works on all that its predecessor kept; the first three return the columns of documents, the last one the
pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import benchmark, language, near_dups, packing
from tidemark.llm.common import stored
from tidemark.llm.queries import TOKENIZER
from tidemark.llm.tables import table

#: No SQL: fitted weights, locality-sensitive hashing and a tokenizer decide; tests hold stages against brute force.
ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can be told: null texts and texts without a letter go, and only they, labels or none.

    Each row is judged by its own text: a null or repeated doc_id, and other columns, change nothing. An empty table
    gives no rows.
    """
    return language.known_only(docs, language.fit(language.training_rows(docs)) or language.any_language())


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest identifier, nulls last.

    Exact copies that share an identifier are a group like others; rows without words all stay. Other columns change
    nothing. An empty table gives no rows.
    """
    return near_dups.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of a benchmark item.

    Each row is judged by its own text: a null or repeated doc_id, and other columns, change nothing. Null and empty
    texts stay. An empty table on either side drops nothing.
    """
    return benchmark.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens; a null text is an empty one, rows that repeat are packed each."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_language),
    ("near-duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
