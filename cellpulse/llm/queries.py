"""Queries of the operators over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellpulse.llm import (
    chat_format,
    collocations,
    filter_audit,
    fingerprints,
    license_scan,
    mixing,
    near_dedup,
    ngram_join,
    packing,
    quality_rules,
    secret_scan,
    token_counts,
    warc,
)
from cellpulse.llm.common import table
from cellpulse.llm.sql import ORACLES
from cellpulse.session import scratch_path


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(license_scan.as_files(table(spark, sf_dir, "documents")))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_table(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are made of control strings."""
    hard = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], turns.schema)
    log = chat_format.log_of_turns(turns.unionByName(added))
    return chat_format.digests(chat_format.render(chat_format.fold(log)))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_packing,
        op3_token_counts,
        op4_quality_rules,
        op5_license_scan,
        op6_fingerprints,
        op7_chat_formatting,
        op8_secret_scan,
        op9_warc,
        op10_mixing,
        op11_near_dedup,
        op12_filter_audit,
        op13_collocations,
    )
}
SQL: dict[str, str] = ORACLES
