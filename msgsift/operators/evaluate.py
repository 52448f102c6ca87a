"""Evaluation of predictions: confusion matrix, metrics, reports, PR curve.

Input is a predictions table (row_id, true_label, predicted_label, spam_probability).
Every metric is one conditional aggregate over the whole table (K labels -> K or K^2
counters), reshaped with ``stack``; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgsift.functions.labels import DEFAULT_LABELS
from msgsift.session import cut_lineage


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _div0(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def prediction_table(pred: DataFrame, *, positive: str = "spam", negative: str = "ham") -> DataFrame:
    """Add is_correct and error_type ("", false_positive_spam, false_negative_spam, other_error)."""
    t, p = F.col("true_label"), F.col("predicted_label")
    err = (
        F.when(t == p, F.lit(""))
        .when((t == negative) & (p == positive), F.lit(f"false_positive_{positive}"))
        .when((t == positive) & (p == negative), F.lit(f"false_negative_{positive}"))
        .otherwise(F.lit("other_error"))
    )
    return pred.withColumn("is_correct", t == p).withColumn("error_type", err)


def confusion_matrix(pred: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """K x K counts in fixed label order, zero cells included: (true_label, pred_<l>...)."""
    cells = pred.agg(*[
        F.count_if((F.col("true_label") == t) & (F.col("predicted_label") == p)).alias(f"c_{i}_{j}")
        for i, t in enumerate(labels) for j, p in enumerate(labels)
    ])
    k = len(labels)
    stack = ", ".join(
        f"{_q(t)}, " + ", ".join(f"c_{i}_{j}" for j in range(k)) for i, t in enumerate(labels)
    )
    names = ", ".join(["true_label"] + [f"pred_{p}" for p in labels])
    return cells.selectExpr(f"stack({k}, {stack}) AS ({names})")


def confusion_rates(pred: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Row-normalised confusion matrix (0 for an empty row)."""
    cm = confusion_matrix(pred, labels)
    tot = sum((F.col(f"pred_{p}") for p in labels), F.lit(0))
    return cm.select("true_label", *[_div0(F.col(f"pred_{p}"), tot).alias(f"rate_{p}") for p in labels])


def rates_from_errors(record: DataFrame, *, positive: str = "spam", negative: str = "ham") -> DataFrame:
    """The same rates from a metric record alone: supports, false positives and false negatives."""
    n, p, fp, fn = (F.col(c) for c in (f"support_{negative}", f"support_{positive}", "false_positives", "false_negatives"))
    rows = record.select(F.explode(F.array(
        F.struct(F.lit(negative).alias("true_label"), _div0(n - fp, n).alias(f"rate_{negative}"), _div0(fp, n).alias(f"rate_{positive}")),
        F.struct(F.lit(positive).alias("true_label"), _div0(fn, p).alias(f"rate_{negative}"), _div0(p - fn, p).alias(f"rate_{positive}")))).alias("r"))
    return rows.select("r.*")


def per_class_stats(pred: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """(class, tp, fp, fn, support, precision, recall, f1_score) for each label."""
    t, p = F.col("true_label"), F.col("predicted_label")
    cnt = pred.agg(*[
        c for i, lab in enumerate(labels) for c in (
            F.count_if((t == lab) & (p == lab)).alias(f"tp_{i}"),
            F.count_if((t != lab) & (p == lab)).alias(f"fp_{i}"),
            F.count_if((t == lab) & (p != lab)).alias(f"fn_{i}"),
            F.count_if(t == lab).alias(f"sup_{i}"),
        )
    ])
    stack = ", ".join(f"{_q(lab)}, tp_{i}, fp_{i}, fn_{i}, sup_{i}" for i, lab in enumerate(labels))
    st = cnt.selectExpr(f"stack({len(labels)}, {stack}) AS (class, tp, fp, fn, support)")
    return st.select(
        "class", "tp", "fp", "fn", "support",
        _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _div0(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1_score"),
    )


def binary_metrics(pred: DataFrame, *, positive: str = "spam", negative: str = "ham") -> DataFrame:
    """One row: accuracy, positive-class precision/recall/F1 (0 when undefined),
    support per label, false positives / negatives."""
    t, p = F.col("true_label"), F.col("predicted_label")
    c = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t == p).alias("correct"),
        F.count_if((t == positive) & (p == positive)).alias("tp"),
        F.count_if((t != positive) & (p == positive)).alias("fp"),
        F.count_if((t == positive) & (p != positive)).alias("fn"),
        F.count_if(t == negative).alias(f"support_{negative}"),
        F.count_if(t == positive).alias(f"support_{positive}"),
        F.count_if((t == negative) & (p == positive)).alias("false_positives"),
        F.count_if((t == positive) & (p == negative)).alias("false_negatives"),
    )
    return c.select(
        _div0(F.col("correct"), F.col("n")).alias("accuracy"),
        _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias(f"{positive}_precision"),
        _div0(F.col("tp"), F.col("tp") + F.col("fn")).alias(f"{positive}_recall"),
        _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias(f"{positive}_f1"),
        f"support_{negative}", f"support_{positive}", "false_positives", "false_negatives",
    )


def averaged_metrics(pred: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """One row: macro and support-weighted precision / recall / F1."""
    pc = per_class_stats(pred, labels)
    tot = F.sum("support")
    return pc.agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1_score").alias("macro_f1"),
        _div0(F.sum(F.col("precision") * F.col("support")), tot).alias("weighted_precision"),
        _div0(F.sum(F.col("recall") * F.col("support")), tot).alias("weighted_recall"),
        _div0(F.sum(F.col("f1_score") * F.col("support")), tot).alias("weighted_f1"),
    )


def classification_report(pred: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Per-class rows plus accuracy, macro avg and weighted avg rows."""
    pc = per_class_stats(pred, labels).select("class", "precision", "recall", "f1_score", "support")
    av = averaged_metrics(pred, labels)
    n = pred.select(F.count(F.lit(1))).scalar()
    acc = pred.select(_div0(F.count_if(F.col("true_label") == F.col("predicted_label")), F.count(F.lit(1)))).scalar()
    acc_row = av.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                        F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"),
                        n.cast("long").alias("support"))
    macro = av.select(F.lit("macro avg").alias("class"), F.col("macro_precision").alias("precision"),
                      F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1_score"),
                      n.cast("long").alias("support"))
    weighted = av.select(F.lit("weighted avg").alias("class"), F.col("weighted_precision").alias("precision"),
                         F.col("weighted_recall").alias("recall"), F.col("weighted_f1").alias("f1_score"),
                         n.cast("long").alias("support"))
    return pc.unionByName(acc_row).unionByName(macro).unionByName(weighted)


def metric_record(pred: DataFrame, strategy: str, labels: Sequence[str] = DEFAULT_LABELS,
                  positive: str = "spam", negative: str = "ham") -> DataFrame:
    """Full one-row metric record tagged with an evaluation strategy.

    One aggregate computes every per-class counter; binary, macro and weighted
    metrics are then plain column arithmetic on that single row."""
    t, p = F.col("true_label"), F.col("predicted_label")
    counters = [F.count(F.lit(1)).alias("n"), F.count_if(t == p).alias("correct")]
    for i, lab in enumerate(labels):
        counters += [
            F.count_if((t == lab) & (p == lab)).alias(f"tp_{i}"),
            F.count_if((t != lab) & (p == lab)).alias(f"fp_{i}"),
            F.count_if((t == lab) & (p != lab)).alias(f"fn_{i}"),
            F.count_if(t == lab).alias(f"sup_{i}"),
        ]
    c = pred.agg(*counters)
    k = len(labels)
    prec = [_div0(F.col(f"tp_{i}"), F.col(f"tp_{i}") + F.col(f"fp_{i}")) for i in range(k)]
    rec = [_div0(F.col(f"tp_{i}"), F.col(f"tp_{i}") + F.col(f"fn_{i}")) for i in range(k)]
    f1 = [_div0(2 * F.col(f"tp_{i}"), 2 * F.col(f"tp_{i}") + F.col(f"fp_{i}") + F.col(f"fn_{i}")) for i in range(k)]
    sup = [F.col(f"sup_{i}") for i in range(k)]
    tot = sum(sup[1:], sup[0])

    def wavg(ms):
        return _div0(sum((m * s for m, s in zip(ms, sup)), F.lit(0.0)), tot)

    ip, ineg = list(labels).index(positive), list(labels).index(negative)
    return c.select(
        F.lit(strategy).alias("evaluation_strategy"),
        _div0(F.col("correct"), F.col("n")).alias("accuracy"),
        prec[ip].alias(f"{positive}_precision"),
        rec[ip].alias(f"{positive}_recall"),
        f1[ip].alias(f"{positive}_f1"),
        sup[ineg].alias(f"support_{negative}"),
        sup[ip].alias(f"support_{positive}"),
        F.col(f"fp_{ip}").alias("false_positives"),
        F.col(f"fn_{ip}").alias("false_negatives"),
        (sum(prec[1:], prec[0]) / k).alias("macro_precision"),
        (sum(rec[1:], rec[0]) / k).alias("macro_recall"),
        (sum(f1[1:], f1[0]) / k).alias("macro_f1"),
        wavg(prec).alias("weighted_precision"),
        wavg(rec).alias("weighted_recall"),
        wavg(f1).alias("weighted_f1"),
    )


def evaluation_comparison(runs: dict[str, DataFrame], labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Metric records of several evaluation strategies side by side (union)."""
    recs = [metric_record(p, name, labels) for name, p in runs.items()]
    out = recs[0]
    for r in recs[1:]:
        out = out.unionByName(r)
    return out


def error_examples(pred: DataFrame, *, positive: str = "spam", score_col: str = "spam_probability") -> DataFrame:
    """Misclassified rows with the confidence of the wrong call, most confident first
    within each error type. The schema is stable even when there are no errors."""
    p = F.col(score_col)
    conf = F.when(F.col("predicted_label") == positive, p).otherwise(1 - p)
    return (
        pred.filter(F.col("error_type") != "")
        .withColumn("confidence", conf)
        .orderBy(F.asc("error_type"), F.desc("confidence"), F.asc("row_id"))
    )


def prevalence(pred: DataFrame, *, positive: str = "spam") -> DataFrame:
    return pred.agg(F.avg((F.col("true_label") == positive).cast("double")).alias("prevalence"))


def _threshold_table(pred: DataFrame, score_col: str, positive: str) -> DataFrame:
    """Per distinct score: pos, neg, and cumulative tp / fp over scores >= it.

    The distinct scores are range-partitioned (sampled bounds, so scores piled up near 0 and 1
    spread evenly) and frozen; each range runs its own sums and adds those of the ranges above,
    from a table with one row per partition.
    """
    g = pred.groupBy(F.col(score_col).alias("score")).agg(
        F.count_if(F.col("true_label") == positive).alias("pos"),
        F.count_if(F.col("true_label") != positive).alias("neg"),
    )
    parts = int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = cut_lineage(g.repartitionByRange(parts, F.desc("score")).withColumn("_pid", F.spark_partition_id()))
    above = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = g.groupBy("_pid").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    offs = per.select(F.col("_pid").alias("_op"), F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_pos"),
                      F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_neg"))
    inside = Window.partitionBy("_pid").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        g.join(F.broadcast(offs), F.col("_pid") == F.col("_op"))
        .withColumn("tp", F.col("_pos") + F.sum("pos").over(inside))
        .withColumn("fp", F.col("_neg") + F.sum("neg").over(inside))
        .drop("_pid", "_op", "_pos", "_neg")
    )


def pr_curve(pred: DataFrame, *, score_col: str = "spam_probability", positive: str = "spam") -> DataFrame:
    """(threshold, precision, recall) at each distinct score (predict positive when
    score >= threshold) plus the end point (null, 1.0, 0.0)."""
    tt = _threshold_table(pred, score_col, positive)
    total_pos = pred.select(F.count_if(F.col("true_label") == positive)).scalar()
    curve = tt.select(
        F.col("score").alias("threshold"),
        _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.when(total_pos == 0, F.lit(1.0)).otherwise(F.col("tp") / total_pos).alias("recall"),
    )
    end = pred.limit(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                               F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


def average_precision(pred: DataFrame, *, score_col: str = "spam_probability", positive: str = "spam") -> DataFrame:
    """Step-wise AP = sum over thresholds of (R_k - R_{k-1}) * P_k; the recall step at
    a threshold is pos_k / P, so no lag is needed."""
    tt = _threshold_table(pred, score_col, positive)
    total_pos = pred.select(F.count_if(F.col("true_label") == positive)).scalar()
    return tt.agg(
        F.coalesce(
            F.sum(F.col("pos") / total_pos * _div0(F.col("tp"), F.col("tp") + F.col("fp"))), F.lit(0.0)
        ).alias("average_precision")
    )
