"""The text operators as registered queries: each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import (
    collocations,
    decontamination,
    fingerprints,
    language,
    licences,
    line_dedup,
    near_dedup,
    oracles,
    pieces,
    sharding,
    substring_dedup,
    token_files,
    toxicity,
    whitening,
)
from orderloom.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_digest(table(spark, sf_dir, "documents"))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_digest(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digest(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passage_digest(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_digest(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.packed_digest(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_licence_scan": op2_licence_scan,
    "op3_toxicity": op3_toxicity,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_language_id": op5_language_id,
    "op6_sharding": op6_sharding,
    "op7_line_dedup": op7_line_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_token_files": op11_token_files,
    "op12_collocations": op12_collocations,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op2_licence_scan": oracles.LICENCES,
    "op7_line_dedup": oracles.LINE_DEDUP,
    "op8_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op9_decontamination": oracles.DECONTAMINATION,
    "op10_minhash_dedup": oracles.NEAR_DEDUP,
    "op12_collocations": oracles.COLLOCATIONS,
}
