"""Registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridemart.llm import align, crf_language, decontaminate, line_dedup, lz_dedup, merge_dropout, ngram_join, phrases, pii, repetition, shards, suffix_dedup, warc
from ridemart.llm.frames import table
from ridemart.llm.oracle import ORACLE  # noqa: F401  (read by the entry module)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_language.identify_all(table(spark, sf_dir, "documents"))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.verdict(repetition.repetition(table(spark, sf_dir, "documents")))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.materialise_order(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"),
                                                            table(spark, sf_dir, "benchmark")))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(ngram_join.near_duplicates(table(spark, sf_dir, "documents")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op8_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_dedup.digest(lz_dedup.remove_earlier(table(spark, sf_dir, "documents")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op10_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.digest(merge_dropout.round_trip(table(spark, sf_dir, "documents")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(spark, warc.write_archives(table(spark, sf_dir, "pages")))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(align.align(table(spark, sf_dir, "documents")))


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op9_pii that SQL on another engine can express."""
    return op9_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_crf_language": op2_crf_language,
    "op3_repetition": op3_repetition,
    "op4_shards": op4_shards,
    "op5_decontaminate": op5_decontaminate,
    "op6_ngram_join": op6_ngram_join,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_lz_dedup": op8_lz_dedup,
    "op9_pii": op9_pii,
    "op10_merge_dropout": op10_merge_dropout,
    "op11_phrases": op11_phrases,
    "op12_warc": op12_warc,
    "op13_align": op13_align,
    "pii_base": pii_base,
}
