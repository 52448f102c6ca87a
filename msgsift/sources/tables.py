"""Views over the input tables: the message relation (row_id, label, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.functions.labels import normalize_label
from msgsift.functions.text import strip_ws
from msgsift.session import ship_package

MESSAGE_COLUMNS = ("row_id", "label", "text")

#: Rows of the largest table of labels that is sent to all tasks (about 60 bytes each), so that no text is shuffled.
SENT_LABELS = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_messages(spark: SparkSession, sf_dir: str, label_column: str = "toxic") -> DataFrame:
    """documents ⋈ labels -> (row_id, label, text).

    ``toxic`` 1/0 maps to spam/ham through the normal label map ("1"->spam,
    "0"->ham); ``quality`` gives a second label axis. Text is stripped like the
    validated message table. The join is an equi-join on doc_id: Catalyst prunes
    both scans to the two columns it needs. Up to ``SENT_LABELS`` counted labels are
    broadcast; above, AQE picks the join from the runtime size of ``labels``.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labs = read_table(spark, sf_dir, "labels").select("doc_id", label_column)
    if labs.count() <= SENT_LABELS:
        labs = F.broadcast(labs)
    return docs.join(labs, "doc_id").select(
        F.col("doc_id").cast("long").alias("row_id"),
        normalize_label(F.col(label_column).cast("string")).alias("label"),
        strip_ws(F.col("text")).alias("text"),
    )


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-class corpus: label = role, row_id = conv_id * 1_000_000 + turn."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(
        (F.col("conv_id") * F.lit(1_000_000) + F.col("turn")).cast("long").alias("row_id"),
        F.lower(strip_ws(F.col("role"))).alias("label"),
        strip_ws(F.col("text")).alias("text"),
    )


def raw_messages(spark: SparkSession, sf_dir: str, label_column: str = "toxic") -> DataFrame:
    """documents ⟕ labels as raw strings: (row_id, label, text), label null when unlabelled."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labs = read_table(spark, sf_dir, "labels").select("doc_id", label_column)
    return docs.join(labs, "doc_id", "left").select(
        F.col("doc_id").cast("long").alias("row_id"),
        F.col(label_column).cast("string").alias("label"),
        F.col("text"),
    )


def labelled_raw(spark: SparkSession, sf_dir: str, label_column: str = "toxic") -> DataFrame:
    """documents ⋈ labels as raw strings (not yet normalised)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labs = read_table(spark, sf_dir, "labels").select("doc_id", label_column)
    return docs.join(labs, "doc_id").select(
        F.col("doc_id").cast("long").alias("row_id"),
        F.col(label_column).cast("string").alias("label"),
        F.col("text"),
    )
