"""Queries over the operators of this subpackage, each taking (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, fingerprints, line_crf, mixing, ngram_join, packing, periodic_runs, phrases, pii, quality_rules, secret_scan, substring_dedup, token_counts
from .common import table
from .sql import ORACLES  # noqa: F401  (read by the driver's entry)

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.report(said.unionByName(chat_format.control_conversation(spark)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken", "copies", "position", "position_again")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(periodic_runs.plant(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_secret_scan, op2_pii, op3_quality_classifier, op4_quality_rules, op5_ngram_join, op6_substring_dedup, op7_chat_format, op8_packing, op9_mixing, op10_fingerprints, op11_token_counts, op12_phrases, op13_periodic_runs)}
