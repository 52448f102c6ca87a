"""Linear classifier on TF-IDF features: fit, score, confidence, persistence,
training metadata and corpus fingerprint.

The fit is an L2-regularised logistic regression with C=1, balanced class weights
``n / (K * n_c)`` and a *penalised* intercept, which is an appended constant feature. It is solved
by a trust-region Newton method over blocks of columns in all partitions (``newton.py``).

A fitted model is a table (idx, term, idf, coefficient) and an intercept. Scoring is a
join of a row's terms with that table and one sum per row; no vector is assembled and no
Python runs per row.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.functions.labels import DEFAULT_LABELS
from msgsift.functions.text import row_counts, strip_ws
from msgsift.operators import newton
from msgsift.operators.features import build_vocabulary, by_repeated_id, tfidf_transform, with_terms
from msgsift.operators.merkle import leaf_digests
from msgsift.operators.quality import assign_row_id
from msgsift.operators.row_blocks import pack_columns
from msgsift.operators.splits import class_weights
from msgsift.operators.term_table import Piece, meet
from msgsift.session import cut_lineage, on_files, remove_folder, scratch_path

#: Terms of the largest weight table that worker processes hold for scoring inside the row (about 60 MB each).
IN_ROW_TERMS = 200_000

#: Training rows whose numbers are sent to all tasks (about 50 bytes each); those of more rows are shuffled.
SENT_ROWS = 2_000_000

class ModelError(ValueError):
    """Raised when a model cannot be fitted, loaded or used."""


@dataclass
class TextClassifier:
    weights: DataFrame        # idx, term, idf, coefficient
    intercept: float
    labels: tuple[str, ...] = DEFAULT_LABELS
    positive: str = "spam"
    passes: int = 0           # of the fit over its rows

    @property
    def negative(self) -> str:
        return next(lab for lab in self.labels if lab != self.positive)


def bounded_rows(train: DataFrame, max_rows: int) -> DataFrame:
    """All rows, or the first ``max_rows`` in md5 order of the row id if there are more. For callers that
    want a sample; ``fit_classifier`` uses every row that it is given."""
    n = train.count()
    if n <= max_rows:
        return train
    first = train.select("row_id", F.md5(F.col("row_id").cast("string")).alias("_k")).orderBy("_k", "row_id").limit(max_rows)
    return train.join(F.broadcast(first.select("row_id")), "row_id", "left_semi")


def fit_classifier(train: DataFrame, *, positive: str = "spam", labels: Sequence[str] = DEFAULT_LABELS,
                   min_df: int = 2, max_passes: int = 1000, tol: float = 5e-7) -> TextClassifier:
    """Fit on all (row_id, label, text) training rows (vocabulary, idf and weights).

    The texts, their entries and the packed vectors lie on shared files until the fit is done. ``passes`` of
    the result is the number of passes that the solver made over them. The driver holds some vectors of one
    number per row.
    """
    spark = train.sparkSession
    folder = scratch_path(spark, "fit")
    try:
        terms = with_terms(on_files(train.select("row_id", "label", "text"), "texts", folder)).select("row_id", "label", "terms")
        vocab = on_files(build_vocabulary(terms, min_df=min_df), "vocabulary", folder)
        if vocab.isEmpty():
            raise ModelError("empty vocabulary: no term reaches min_df")
        weighted = class_weights(terms.select("row_id", "label")).where(F.col("row_id").isNotNull())
        rows = assign_row_id(weighted.select("row_id", F.coalesce((F.col("label") == positive).cast("double"), F.lit(0.0)).alias("y"), F.col("weight").alias("s")),
                             ["row_id"], out="i")
        # One small row per training row.
        facts = rows.select(F.col("i"), "y", "s").toPandas().sort_values("i")
        entries = on_files(tfidf_transform(terms, vocab, term=False).where(F.col("idx").isNotNull()), "entries", folder)
        numbered = entries.join(_sent(rows.select("row_id", (F.col("i") - 1).alias("i")), len(facts)), "row_id")
        blocks = pack_columns(numbered.select("i", "idx", F.col("weight").alias("value")), folder)
        a, passes = newton.fit(blocks, facts["y"].to_numpy(float), facts["s"].to_numpy(float), tol=tol, max_passes=max_passes)
        # A term that only rows without a label hold weighs nothing, but counts in the norm of a row.
        weights = on_files(vocab.join(newton.coefficients(blocks, a), "idx", "left").select(
            "idx", "term", "idf", F.coalesce("coefficient", F.lit(0.0)).alias("coefficient")), "weights")
    finally:
        remove_folder(spark, folder)
    return TextClassifier(weights, float(a.sum()), tuple(labels), positive, passes)


def _sent(rows: DataFrame, n: int) -> DataFrame:
    """A small table of ``n`` rows for every task, if they are not too many."""
    return F.broadcast(rows) if n <= SENT_ROWS else rows


def margins(clf: TextClassifier, df: DataFrame, text_col: str = "text") -> DataFrame:
    """(row_id, margin): the row's normalised TF-IDF times the coefficients, plus the intercept.

    Rows without a known term keep the intercept as their margin.
    """
    terms = with_terms(df.select("row_id", F.col(text_col).alias("text"))).select("row_id", "terms")
    once, again = by_repeated_id(terms)
    sums = _sums(clf, once)
    if again is not None:
        tf = row_counts(again, "terms")
        w = (1 + F.log("tf")) * F.col("idf")
        known = tf.join(clf.weights.select(F.col("term").alias("_t"), "idf", "coefficient"), F.col("term") == F.col("_t"), "left")
        sums = sums.unionByName(known.groupBy("row_id").agg(F.sum(w * F.col("coefficient")).alias("s"), F.sum(w * w).alias("q")))
    return sums.select("row_id", (F.when(F.col("q") > 0, F.col("s") / F.sqrt("q")).otherwise(0.0) + F.lit(clf.intercept)).alias("margin"))


def _sums(clf: TextClassifier, terms: DataFrame) -> DataFrame:
    """(row_id, s, q) of rows (row_id, terms): the sums of the weights times the coefficients and of the squared weights."""

    def finish(p: Piece) -> pa.RecordBatch:
        idf, coefficient = p.values
        row, place, tf = p.entries()
        w = (1 + np.log(tf)) * idf[place]
        # Without any entry bincount gives whole numbers.
        sums = [np.bincount(row, x, minlength=len(p.ids)).astype(np.float64) for x in (w * coefficient[place], w * w)]
        return pa.RecordBatch.from_arrays([p.ids, *map(pa.array, sums)], ["row_id", "s", "q"])

    return meet(terms, clf.weights, ["idf", "coefficient"], finish, f"row_id {terms.schema['row_id'].dataType.simpleString()}, s double, q double")


def fits_in_row(clf: TextClassifier) -> bool:
    """Whether the weight table is small enough for ``margin_in_row``."""
    return clf.weights.limit(IN_ROW_TERMS + 1).count() <= IN_ROW_TERMS


def with_margin(clf: TextClassifier, rows: DataFrame, text_col: str, out: str, where: Column | None = None) -> DataFrame:
    """Every row of a batch with its margin (null unless ``where``), for weight tables of any size.

    The rows are numbered on shared files, so they need no id, and meet the weights by a join."""
    kept = cut_lineage(rows.withColumn("_key", F.monotonically_increasing_id()))
    some = kept if where is None else kept.where(where)
    return kept.join(margins_by_key(clf, some, text_col, out), "_key", "left").drop("_key")


def margins_by_key(clf: TextClassifier, rows: DataFrame, text_col: str, out: str) -> DataFrame:
    """(_key, the margin as ``out``) of rows with different numbers ``_key``."""
    terms = with_terms(rows.select(F.col("_key").alias("row_id"), F.col(text_col).alias("text"))).select("row_id", "terms")
    margin = F.when(F.col("q") > 0, F.col("s") / F.sqrt("q")).otherwise(0.0) + F.lit(clf.intercept)
    return _sums(clf, terms).select(F.col("row_id").alias("_key"), margin.alias(out))


_tables: dict[str, dict[str, tuple[float, float]]] = {}


def margin_in_row(clf: TextClassifier, terms) -> Column:
    """The margin of a row from its array of terms, without a join or an aggregation.

    The weight table (at most ``IN_ROW_TERMS``, see ``fits_in_row``) is sent to the tasks once; each worker
    process keeps it as a dictionary. For plans that cannot shuffle: streams and pipeline stages.
    """
    spark = clf.weights.sparkSession
    sent = spark.sparkContext.broadcast(clf.weights.select("term", "idf", "coefficient").toArrow())
    name, intercept = uuid.uuid4().hex, clf.intercept

    def run(rows: pd.Series) -> pd.Series:
        if name not in _tables:
            _tables.clear()
            t = sent.value
            _tables[name] = dict(zip(t["term"].to_pylist(), zip(t["idf"].to_pylist(), t["coefficient"].to_pylist(), strict=True), strict=True))
        table, out = _tables[name], []
        for row in rows:
            total = square = 0.0
            for term, n in Counter(() if row is None else row).items():
                if term in table:
                    idf, coefficient = table[term]
                    w = (1.0 + math.log(n)) * idf
                    total += w * coefficient
                    square += w * w
            out.append((total / math.sqrt(square) if square else 0.0) + intercept)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(run, "double")(terms)


def probability(margin) -> F.Column:
    """Logistic function in the form that does not overflow on either side."""
    e = F.exp(-F.abs(margin))
    return F.when(margin >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def score_messages(clf: TextClassifier, df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(row_id, predicted_label, spam_probability) for every row (zero vectors included)."""
    p = probability(F.col("margin"))
    return margins(clf, df, text_col).select(
        "row_id",
        F.when(F.col("margin") > 0, F.lit(clf.positive)).otherwise(F.lit(clf.negative)).alias("predicted_label"),
        p.alias(f"{clf.positive}_probability"),
    )


def predict_confidence(clf: TextClassifier, df: DataFrame, *, text_col: str = "text",
                       id_col: str = "row_id") -> DataFrame:
    """(row_id, label, confidence, rejected): confidence of the predicted class; blank
    texts are rejected rows (label/confidence null), never exceptions. Ids must be unique."""
    blank = F.col(text_col).isNull() | (strip_ws(F.col(text_col)) == "")
    base = df.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("text")).withColumn("rejected", blank)
    scored = score_messages(clf, base.filter(~F.col("rejected")))
    p = F.col(f"{clf.positive}_probability")
    return base.join(scored, "row_id", "left").select(
        "row_id",
        F.col("predicted_label").alias("label"),
        F.greatest(p, 1 - p).alias("confidence"),
        "rejected",
    )


def fit_report(clf: TextClassifier, train: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row of facts that hold for a right fit: rows, features, and whether the largest entry of
    the gradient of the objective per row, intercept included, is below ``tolerance``."""
    weighted = class_weights(train.select("row_id", "label"))
    y = (F.col("label") == clf.positive).cast("double")
    residual = cut_lineage(weighted.join(margins(clf, train), "row_id", "left").select(
        "row_id", (F.col("weight") * (probability(F.coalesce("margin", F.lit(clf.intercept))) - y)).alias("res")))
    bias = residual.agg(F.count(F.lit(1)).alias("rows"), F.abs(F.sum("res") + F.lit(clf.intercept)).alias("b")).first()
    lines = tfidf_transform(with_terms(train).select("row_id", "terms"), clf.weights, term=False).filter(F.col("idx").isNotNull())
    per_term = lines.join(_sent(residual, bias["rows"]), "row_id").groupBy("idx").agg(F.sum(F.col("weight") * F.col("res")).alias("g"))
    worst = clf.weights.join(per_term, "idx", "left").agg(
        F.count(F.lit(1)).alias("features"), F.max(F.abs(F.coalesce("g", F.lit(0.0)) + F.col("coefficient"))).alias("g"))
    return worst.select(F.lit(bias["rows"]).cast("long").alias("rows"), "features",
                        (F.greatest("g", F.lit(bias["b"])) / bias["rows"] < tolerance).alias("gradient_vanishes"))


def persist_model(clf: TextClassifier, path: str, metadata: dict | None = None) -> None:
    """Save the weight table and a metadata record."""
    clf.weights.write.mode("overwrite").parquet(f"{path}/weights")
    meta = {"intercept": clf.intercept, "labels": list(clf.labels), "positive": clf.positive, **(metadata or {})}
    spark = clf.weights.sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> TextClassifier:
    """Load and validate a persisted classifier (weight table, class metadata)."""
    try:
        weights = spark.read.parquet(f"{path}/weights")
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    except Exception as exc:  # noqa: BLE001
        raise ModelError(f"no readable model at {path}") from exc
    return checked_model(weights, meta, path)


def checked_model(weights: DataFrame, meta: dict, path: str) -> TextClassifier:
    """A classifier from a stored table and record, or ``ModelError`` naming ``path``."""
    missing = {"idx", "term", "idf", "coefficient"} - set(weights.columns)
    if missing:
        raise ModelError(f"the weight table at {path} lacks {sorted(missing)}")
    labels = tuple(meta.get("labels") or ())
    if len(set(labels)) != 2 or meta.get("positive") not in labels or not isinstance(meta.get("intercept"), float):
        raise ModelError(f"the metadata at {path} does not describe a model of two classes")
    check = weights.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("term").alias("terms"),
                        F.count_if(F.col("coefficient").isNull() | F.isnan("coefficient") | F.col("idf").isNull()).alias("bad")).first()
    if not check["n"] or check["terms"] != check["n"] or check["bad"]:
        raise ModelError(f"the weight table at {path} is empty, repeats terms or has undefined weights")
    return TextClassifier(weights, meta["intercept"], labels, meta["positive"])


def training_metadata(split_df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS,
                      test_size: float = 0.2, seed: int = 42, min_df: int = 2) -> DataFrame:
    """One row: row and class counts overall and per side, the corpus's duplicate summary, and the
    parameters of split, representation and classifier."""
    from msgsift.operators.quality import duplicate_stats

    cols = [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("split") == "train").alias("train_rows"),
            F.count_if(F.col("split") == "test").alias("test_rows")]
    for lab in labels:
        cols.append(F.count_if(F.col("label") == lab).alias(f"class_{lab}"))
        cols.append(F.count_if((F.col("label") == lab) & (F.col("split") == "train")).alias(f"train_{lab}"))
        cols.append(F.count_if((F.col("label") == lab) & (F.col("split") == "test")).alias(f"test_{lab}"))
    dups = duplicate_stats(split_df)
    out = split_df.agg(*cols).withColumn("_d", dups.select(F.struct(*dups.columns)).scalar())
    return out.select(
        "*", "_d.*", F.lit(float(test_size)).alias("test_size"), F.lit(int(seed)).alias("random_state"),
        F.lit("tfidf").alias("representation"), F.lit("1-2").alias("ngram_range"), F.lit(int(min_df)).alias("min_df"),
        F.lit(True).alias("sublinear_tf"), F.lit("logistic_regression").alias("classifier"), F.lit(1.0).alias("c"),
        F.lit("balanced").alias("class_weight"), F.lit(1000).alias("max_iter")).drop("_d")


def corpus_fingerprint(df: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """Order-independent provenance digest (rows, fingerprint) of a (label, text) multiset.

    Rows are dealt to 65,536 leaves by digest prefix (``merkle.py``); the leaves' digests are hashed
    once more, so no group holds the corpus."""
    leaf = leaf_digests(df, label_col, text_col).select("rows", F.struct("prefix", "digest").alias("l"))
    return leaf.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"), F.sha2(F.array_join(F.transform(F.sort_array(
        F.collect_list("l")), lambda x: x["digest"]), ",").cast("binary"), 256).alias("fingerprint"))


def verify_fingerprint(df: DataFrame, expected: str, **kw) -> None:
    got = corpus_fingerprint(df, **kw).first()["fingerprint"]
    if got != expected:
        raise ModelError(f"the corpus has the fingerprint {got}, not the recorded {expected}")
