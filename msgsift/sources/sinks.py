"""Writers and the validated-table loader (contract check)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from msgsift.functions.labels import DEFAULT_LABELS, normalize_label
from msgsift.functions.text import strip_ws
from msgsift.operators.quality import DatasetValidationError, row_quality_flags
from msgsift.session import scratch_path

MESSAGE_SCHEMA = StructType([
    StructField("row_id", LongType(), False),
    StructField("label", StringType(), False),
    StructField("text", StringType(), False),
])
#: Written and read alike, so quotes, delimiters, line breaks and empty texts survive.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "quoteAll": "true", "multiLine": "true", "emptyValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "lineSep": "\n"}


def _csv(io: DataFrameReader | DataFrameWriter):
    names = set(CSV_OPTIONS) - ({"multiLine"} if isinstance(io, DataFrameWriter) else {"quoteAll", "lineSep"})
    return io.options(**{k: CSV_OPTIONS[k] for k in names})


def write_messages(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Persist the normalised message table (Parquet by default; CSV optional)."""
    w = df.select("row_id", "label", "text").write.mode(mode)
    _csv(w).csv(path) if fmt == "csv" else w.parquet(path)


def write_checked(raw: DataFrame, messages_path: str, quarantine_path: str, *, permissive: bool = False) -> dict:
    """Check and write (row_id, label, text) rows in one pass; returns the counts.

    The flagged rows are written once, good and bad ones apart, while an ``Observation`` counts
    them. Then the quarantined rows (with their flags) are put in place, and after them the
    normalised messages. Bad rows stop that, unless ``permissive``: then no messages are written and
    the error says how many rows are wrong and where they are.
    """
    spark = raw.sparkSession
    flagged = row_quality_flags(raw).withColumn("bad", F.col("missing_label") | F.col("missing_text") | F.col("invalid_label"))
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("raw_rows"), *[F.count_if(c).alias(f"{c}_count") for c in ("missing_label", "missing_text", "invalid_label", "bad")]]
    rows = flagged.withColumn("message_label", normalize_label(F.col("label"))).withColumn("message_text", strip_ws(F.col("text")))
    staged = scratch_path(spark, "checked")
    rows.observe(seen, *counts).write.partitionBy("bad").parquet(staged)
    facts = {k: int(v) for k, v in seen.get.items()}
    written = spark.read.schema(rows.schema).parquet(staged)
    if facts["bad_count"]:
        written.where("bad").select("row_id", "label", "text", "missing_label", "missing_text", "invalid_label").write.mode("overwrite").parquet(quarantine_path)
        if not permissive:
            raise DatasetValidationError(f"{facts['missing_label_count']} rows lack a label, {facts['missing_text_count']} a text and "
                                         f"{facts['invalid_label_count']} have unknown labels; all are listed in {quarantine_path}")
    good = written.where("NOT bad").select("row_id", F.col("message_label").alias("label"), F.col("message_text").alias("text"))
    write_messages(good, messages_path)
    return facts


def write_report_tables(tables: Mapping[str, DataFrame], out_dir: str, *, fmt: str = "parquet") -> dict[str, str]:
    """Write each result table to ``out_dir/<name>``; never coalesces large tables."""
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        _csv(w).csv(paths[name]) if fmt == "csv" else w.parquet(paths[name])
    return paths


def write_run_record(record: DataFrame, path: str, provider_col: str = "embedding_provider") -> None:
    """Store run records by provider: a run replaces the records of its own providers only (dynamic
    partition overwrite), and ``spark.read.parquet(path)`` is the global table of the latest runs."""
    record.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(provider_col).parquet(path)


def write_summary_json(summary: DataFrame, path: str) -> dict:
    """Write a one-row summary as JSON and return it (the one row is all that is collected)."""
    rows = summary.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("summary must have exactly one row")
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return rows[0].asDict(recursive=True)


def load_messages(spark: SparkSession, path: str, *, fmt: str = "parquet",
                  labels: tuple[str, ...] = DEFAULT_LABELS) -> DataFrame:
    """Load a validated message table and check its contract with one aggregate.

    All unexpected labels are written to a table whose path the error names.
    """
    raw = _csv(spark.read).csv(path) if fmt == "csv" else spark.read.parquet(path)
    missing = [c for c in ("row_id", "label", "text") if c not in raw.columns]
    if missing:
        raise DatasetValidationError(f"{path} lacks the columns {missing}; it has {raw.columns}")
    df = raw.select(F.col("row_id").cast("string").alias("_rid"), F.col("label").cast("string").alias("label"),
                    F.col("text").cast("string").alias("text"))
    low = F.lower("label")
    check = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_rid").try_cast("long").isNull()).alias("bad_ids"),
        F.count_if(low.isNull() | ~low.isin(list(labels))).alias("unexpected"),
        *[F.count_if(low == lab).alias(f"n_{i}") for i, lab in enumerate(labels)],
    ).first()
    if check["n"] == 0:
        raise DatasetValidationError(f"{path} has no rows")
    if check["bad_ids"]:
        raise DatasetValidationError(f"{check['bad_ids']} values of row_id in {path} are no integers")
    absent = [lab for i, lab in enumerate(labels) if check[f"n_{i}"] == 0]
    if check["unexpected"]:
        where = scratch_path(spark, "unexpected-labels")
        df.select(low.alias("label")).where(F.col("label").isNull() | ~F.col("label").isin(list(labels))).groupBy("label").agg(
            F.count(F.lit(1)).alias("rows")).write.parquet(where)
        raise DatasetValidationError(f"{check['unexpected']} rows of {path} have labels other than {sorted(labels)}; all are listed in {where}")
    if absent:
        raise DatasetValidationError(f"{path} has no rows with the labels {absent}")
    return df.select(F.col("_rid").cast("long").alias("row_id"), "label", F.coalesce("text", F.lit("")).alias("text"))
