"""From raw documents to token ids, in stages that are each written and read again.

A stage takes the session, the documents that the one before it kept and the folder of the tables, and returns documents
with the same columns; the last returns token ids instead of texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import decontamination, language, line_dedup, near_dedup, pieces
from orderloom.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every language that the documents name, go."""
    return language.with_known_language(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of smaller id has go, and documents of which nothing stays."""
    return line_dedup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by four fifths of their five-word shingles, the one of least id stays."""
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more are benchmark passages go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of texts, and whether they spell the text."""
    return pieces.as_tokens(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", tokenize),
]

# Profiles are learned and token paths searched for, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
