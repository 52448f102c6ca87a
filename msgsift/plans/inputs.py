"""Deterministic prediction inputs for the evaluation queries.

A log-rate-ratio scorer trained on the train side only: a message's score is the
sum over its tokens of the term's smoothed spam-vs-ham log-rate ratio (unknown
terms add 0). Everything is a join/aggregate, so the same predictions are
expressible in SQL and the evaluation operators can be compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.functions.text import counted_in_row
from msgsift.operators import corpus as C
from msgsift.operators import splits as S
from msgsift.operators._util import round_half_up
from msgsift.session import on_files
from msgsift.sources.tables import labelled_messages


def stable_sigmoid(s: Column) -> Column:
    return F.when(s >= 0, 1 / (1 + F.exp(-s))).otherwise(F.exp(s) / (1 + F.exp(s)))


def stored_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled messages with their tokens as a table in the shared folder, for several strategies."""
    return on_files(C.with_tokens(labelled_messages(spark, sf)), "messages")


def split_messages(spark: SparkSession, sf: str, strategy: str = "row", msgs: DataFrame | None = None) -> DataFrame:
    msgs = labelled_messages(spark, sf) if msgs is None else msgs
    if strategy == "row":
        return S.stratified_split(msgs)
    out, _seed = S.grouped_split(msgs)
    return out


def ratio_predictions(split_df: DataFrame, *, text: bool = True) -> DataFrame:
    """Predictions of the test rows, with their texts if ``text``.

    The rows are cut into tokens once (unless they have them), for a table in the shared folder that
    every later step reads.
    A test row's terms are counted inside the row.
    """
    extra = [F.when(F.col("split") == "test", F.col("text")).alias("text")] if text else []
    tok = split_df if "tokens" in split_df.columns else C.with_tokens(split_df)
    tok = on_files(tok.select("row_id", "label", "split", "tokens", *extra), "split-tokens")
    train, test = tok.filter(F.col("split") == "train"), tok.filter(F.col("split") == "test")
    ratios = C.term_scores(train).select("token", F.col("log_rate_ratio_spam_vs_ham").alias("ratio"))
    per_row = (
        counted_in_row(test, "tokens").withColumnRenamed("term", "token")
        .join(ratios, "token", "left")
        .groupBy("row_id")
        .agg(F.sum(F.col("tf") * F.coalesce(F.col("ratio"), F.lit(0.0))).alias("s"))
    )
    s = F.coalesce(F.col("s"), F.lit(0.0))
    return test.select("row_id", F.col("label").alias("true_label"), *["text"] * text).join(per_row, "row_id", "left").select(
        "row_id",
        "true_label",
        F.when(s > 0, "spam").otherwise("ham").alias("predicted_label"),
        round_half_up(stable_sigmoid(s), 9).alias("spam_probability"),
        *["text"] * text,
    )


def predictions(spark: SparkSession, sf: str, strategy: str = "row", *, text: bool = True,
                msgs: DataFrame | None = None) -> DataFrame:
    return ratio_predictions(split_messages(spark, sf, strategy, msgs), text=text)
