"""Validation of a raw message file into the numbered message table and its JSON record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.functions.labels import normalize_label
from msgsift.functions.text import strip_ws
from msgsift.operators.quality import assign_row_id, dedup_keep_first, enforce_quality, validation_counts
from msgsift.sources.delimited import read_messages, resolve_columns
from msgsift.sources.sinks import load_messages, write_messages, write_summary_json

# How the record names the delimiters.
DELIMITER_NAMES = {"\t": "tab", ",": "comma", ";": "semicolon"}


def validate_dataset(spark: SparkSession, raw_path: str, out_path: str, summary_path: str | None = None, *,
                     quoting: bool = True, drop_duplicates: bool = False) -> tuple[DataFrame, dict]:
    """Read, resolve columns, check quality (fail fast), normalise, number in file order, drop
    duplicates if asked, write, and load with the contract check. Returns the loaded messages and
    the record, which is also written as JSON to ``summary_path``."""
    raw, opts = read_messages(spark, raw_path, quoting=quoting)
    label_col, text_col = resolve_columns(raw)
    columns = [c for c in raw.columns if c != "_order"]
    raw = assign_row_id(raw.select(F.col(f"`{label_col}`").alias("label"), F.col(f"`{text_col}`").alias("text"), "_order"),
                        ["_order"]).drop("_order")
    enforce_quality(raw)
    messages = raw.select("row_id", normalize_label(F.col("label")).alias("label"), strip_ws(F.col("text")).alias("text"))
    if drop_duplicates:
        messages = dedup_keep_first(messages)
    write_messages(messages, out_path)
    facts = {"input_file": raw_path, "output_file": out_path, "summary_file": summary_path or "", "label_column": label_col,
             "text_column": text_col, "delimiter": DELIMITER_NAMES[opts.delimiter], "encoding": opts.encoding}
    record = validation_counts(raw, drop_duplicates=drop_duplicates).select(
        *[F.lit(v).alias(k) for k, v in facts.items()], F.array(*[F.lit(c) for c in columns]).alias("detected_columns"), "*")
    summary = write_summary_json(record, summary_path) if summary_path else record.first().asDict()
    return load_messages(spark, out_path), summary
