"""Data-quality checks, normalisation, row numbering and duplicate handling.

Duplicate detection groups by a SHA-256 digest of the text instead of the text
itself, so the shuffle carries 64 hex characters per row however long the
message is; partial aggregation collapses hot texts on the map side and semi
joins on the digest are split by AQE when one text is very frequent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgsift.functions.labels import DEFAULT_LABELS, normalize_label
from msgsift.functions.text import strip_ws
from msgsift.session import on_files, scratch_path


class DatasetValidationError(ValueError):
    """Raised when a message table fails validation."""


def text_key(c: str = "text") -> F.Column:
    """Digest used as the grouping key for exact-text equality."""
    return F.sha2(F.col(c), 256)


def row_quality_flags(df: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """Add missing_label, missing_text, invalid_label boolean columns."""
    lab, txt = F.col(label_col), F.col(text_col)
    missing_label = lab.isNull() | (strip_ws(lab.cast("string")) == "")
    missing_text = txt.isNull() | (strip_ws(txt.cast("string")) == "")
    return (
        df.withColumn("missing_label", missing_label)
        .withColumn("missing_text", missing_text)
        .withColumn("invalid_label", normalize_label(lab).isNull() & ~F.col("missing_label"))
    )


def invalid_label_values(flagged: DataFrame, label_col: str = "label") -> DataFrame:
    """(invalid_value, rows): distinct stripped invalid label values, a table and not a list."""
    return (
        flagged.filter("invalid_label")
        .groupBy(strip_ws(F.col(label_col).cast("string")).alias("invalid_value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def quality_summary(flagged: DataFrame, label_col: str = "label") -> DataFrame:
    """One row of counts over a flagged table."""
    n_invalid_values = invalid_label_values(flagged, label_col).select(F.count(F.lit(1))).scalar()
    return flagged.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if("missing_label").alias("missing_label_count"),
        F.count_if("missing_text").alias("missing_text_count"),
        F.count_if("missing_text").alias("empty_text_count"),
        F.count_if("invalid_label").alias("invalid_label_count"),
    ).withColumn("distinct_invalid_labels", n_invalid_values)


def enforce_quality(
    df: DataFrame, *, label_col: str = "label", text_col: str = "text", mode: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Fail fast (default) or split into (valid, quarantine). To check in the pass that writes the
    messages, use ``sinks.write_checked``.

    ``mode="fail"`` runs one aggregate and raises with every problem joined by
    "; " before any message is written; all invalid label values go, with their
    counts, to a table in the shared folder that the error names.
    ``mode="permissive"`` returns the valid rows and the quarantined rows with
    their flags. ``mode="in_plan"`` returns rows that raise when a bad one is read: no scan of its
    own, but a plan that stops anywhere in the middle.
    """
    flagged = row_quality_flags(df, label_col, text_col)
    bad = F.col("missing_label") | F.col("missing_text") | F.col("invalid_label")
    if mode == "permissive":
        return flagged.filter(~bad).drop("missing_label", "missing_text", "invalid_label"), flagged.filter(bad)
    if mode == "in_plan":
        why = F.concat(F.lit("a row lacks a label or a text, or has an unknown label: "), F.coalesce(F.col(label_col).cast("string"), F.lit("null")))
        checked = flagged.withColumn(label_col, F.when(bad, F.raise_error(why).cast("string")).otherwise(F.col(label_col)))
        return checked.drop("missing_label", "missing_text", "invalid_label"), flagged.filter(bad)
    if mode != "fail":
        raise ValueError("mode must be 'fail', 'permissive' or 'in_plan'")
    s = quality_summary(flagged, label_col).first()
    errors = []
    if s["missing_label_count"]:
        errors.append(f"{s['missing_label_count']} rows lack a label")
    if s["missing_text_count"]:
        errors.append(f"{s['missing_text_count']} rows lack a text")
    if s["invalid_label_count"]:
        where = scratch_path(df.sparkSession, "invalid-labels")
        invalid_label_values(flagged, label_col).write.parquet(where)
        errors.append(f"{s['invalid_label_count']} rows have one of {s['distinct_invalid_labels']} unknown label values, listed in {where}")
    if errors:
        raise DatasetValidationError("; ".join(errors))
    return flagged.drop("missing_label", "missing_text", "invalid_label"), flagged.filter(bad)


def normalize_messages(df: DataFrame, label_col: str = "label", text_col: str = "text",
                       id_col: str | None = "row_id") -> DataFrame:
    """Canonical label, stripped text, projected to the message columns."""
    cols = [F.col(id_col).alias("row_id")] if id_col else []
    return df.select(
        *cols,
        normalize_label(F.col(label_col)).alias("label"),
        strip_ws(F.col(text_col).cast("string")).alias("text"),
    )


def assign_row_id(df: DataFrame, order_cols: Sequence[str], out: str = "row_id",
                  num_partitions: int | None = None) -> DataFrame:
    """Dense 1..n numbering in the order of ``order_cols`` without a one-partition sort.

    Range-partition and sort by the key, take each row's index inside its partition,
    freeze that in a table in the shared folder (so recomputation after executor loss
    cannot change it, and readers take the columns they need), then add the running row count of the preceding partitions
    (a table with one row per partition, broadcast).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    local = ordered.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    )
    local = on_files(local, "numbered")
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    ).select("_pid", "_off")
    return (
        local.join(F.broadcast(offsets), "_pid")
        .withColumn(out, (F.col("_off") + F.col("_local") + 1).cast("long"))
        .drop("_pid", "_local", "_off")
    )


def duplicate_rows(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows whose text occurs more than once (all copies kept)."""
    dup = (
        df.groupBy(text_key(text_col).alias("_h"))
        .agg(F.count(F.lit(1)).alias("_cnt"))
        .filter(F.col("_cnt") > 1)
        .select("_h")
    )
    return df.withColumn("_h", text_key(text_col)).join(dup, "_h", "left_semi").drop("_h")


def duplicate_stats(df: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """One row: duplicate_message_count, duplicate_message_groups, exact_duplicate_row_count."""
    by_text = df.groupBy(text_key(text_col).alias("_h")).agg(F.count(F.lit(1)).alias("cnt"))
    by_pair = df.groupBy(F.col(label_col), text_key(text_col).alias("_h")).agg(F.count(F.lit(1)).alias("cnt"))
    exact = by_pair.select(F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))), F.lit(0)).cast("long")).scalar()
    return by_text.agg(
        F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))), F.lit(0)).cast("long").alias(
            "duplicate_message_count"
        ),
        F.count_if(F.col("cnt") > 1).alias("duplicate_message_groups"),
    ).withColumn("exact_duplicate_row_count", exact)


def dedup_keep_first(df: DataFrame, text_col: str = "text", id_col: str = "row_id",
                     renumber: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct text, the lowest ``row_id`` wins; optional 1..n renumbering.

    ``min(struct(row_id, ...))`` is a deterministic survivor (``dropDuplicates`` is
    not) and aggregates partially, so a hot text costs one row per map partition.
    The original id is kept as ``source_row_id``. ``columns`` are the others wanted (default: all);
    without the text among them none is shuffled.
    """
    others = [c for c in (df.columns if columns is None else columns) if c not in (id_col,)]
    first = df.groupBy(text_key(text_col).alias("_h")).agg(
        F.min(F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in others])).alias("_r")
    )
    kept = first.select(F.col("_r._id").alias("source_row_id"), *[F.col(f"_r.{c}").alias(c) for c in others])
    if not renumber:
        return kept.withColumnRenamed("source_row_id", id_col)
    return assign_row_id(kept, ["source_row_id"], out=id_col)


def label_counts(df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS, label_col: str = "label") -> DataFrame:
    """One row with a ``<label>_count`` column per label (0 when absent)."""
    return df.agg(*[F.count_if(F.col(label_col) == lab).alias(f"{lab}_count") for lab in labels])


def validation_counts(raw: DataFrame, *, drop_duplicates: bool = False, label_col: str = "label",
                      text_col: str = "text", id_col: str = "row_id") -> DataFrame:
    """Numeric part of the validation summary over a raw (id, label, text) table."""
    flagged = row_quality_flags(raw, label_col, text_col)
    bad = F.col("missing_label") | F.col("missing_text") | F.col("invalid_label")
    valid = normalize_messages(flagged.filter(~bad), label_col, text_col, id_col)
    dups = duplicate_stats(valid)
    final = dedup_keep_first(valid, renumber=False, columns=["label"]) if drop_duplicates else valid
    kept = final.agg(
        F.count(F.lit(1)).alias("validated_rows"),
        F.count_if(F.col("label") == "ham").alias("ham_count"),
        F.count_if(F.col("label") == "spam").alias("spam_count"),
    )
    counts = flagged.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if("missing_label").alias("missing_label_count"),
        F.count_if("missing_text").alias("missing_text_count"),
        F.count_if("missing_text").alias("empty_text_count"),
        F.count_if("invalid_label").alias("invalid_label_count"),
        F.count_if(~bad).alias("_valid"),
    )
    # One subquery per table, each returning its row as a struct.
    out = counts.withColumn("_k", kept.select(F.struct(*kept.columns)).scalar()).withColumn(
        "_d", dups.select(F.struct(*dups.columns)).scalar())
    return out.select(*[c for c in counts.columns if c != "_valid"], "_k.*", "_d.*",
                      (F.col("_valid") - F.col("_k.validated_rows")).cast("long").alias("duplicate_messages_removed"))
