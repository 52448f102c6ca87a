"""Corpus pipeline: quality filter, line dedup, near-dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns a DataFrame;
all but the last return the columns of ``docs``. ``run`` applies them to ``documents`` and cuts
the lineage between stages with tables in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.llm import decontaminate, line_dedup, mixing, quality, simhash
from msgsift.llm._common import read_table, shared_table

#: Share of a host's distinct pages above which a line is boilerplate: well below the 4 to 13 % of the
#: common lines of the tables, so that it does not depend on chance which hosts are cleaned of them.
BOILERPLATE_RATIO = 0.02


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose quality score is below the threshold."""
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, quality.score_udf(model, spark)(F.col("text")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut each source's boilerplate lines out of the texts, copies counted once; ``n_chars`` follows the text."""
    out = line_dedup.drop_lines(docs, max_ratio=BOILERPLATE_RATIO, copies_once=True)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark window."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per epoch that takes a document, numbered by ``epoch``."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("source_mixing", mix_sources),
]

#: Fitted scores and 64-bit shingle hashes are not SQL; tests/llm compares with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
