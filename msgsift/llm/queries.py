"""Registered queries of the training-data operators (whole tables, production parameters)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    quality,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    toxicity,
)
from msgsift.llm._common import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its host's boilerplate lines removed; the source is the host."""
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(read_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(read_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.notices(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 100; ids divisible by 7 carry the next label (of ten) first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run starts from an empty cache of its own, so its figures are those of the whole work."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_html_extraction": op3_html_extraction,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_license_scan": op10_license_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_counts": op12_token_counts,
    "op13_spelling_variants": op13_spelling_variants,
}
