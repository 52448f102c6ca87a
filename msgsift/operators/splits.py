"""Deterministic splits, samples, leakage statistics and class weights.

Order is ``md5('<seed>:<key>')`` (identical in Spark and DuckDB). "Take the first q
rows in md5 order" is an exact quantile cut done without any global sort:

1. count rows per (part, first 4 hex digits of the key) - at most 65,536 buckets per
   part, a small table;
2. a running sum over that small table finds the bucket holding the q-th key;
3. only the rows of that one boundary bucket are ranked, giving the exact
   threshold key (one row per part, broadcast);
4. every row compares its own key with its part's threshold - a narrow filter,
   no join on the data key, so a hot key or group cannot skew anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgsift.functions.labels import DEFAULT_LABELS
from msgsift.operators.quality import text_key
from msgsift.session import on_files


class SplitError(ValueError):
    """Raised when a split cannot be built."""


def md5_order(seed: int, c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")))


def cut_thresholds(
    df: DataFrame, key: str, tie: str, quota: DataFrame, parts: Sequence[str], hex_digits: int = 4
) -> DataFrame:
    """Per part, the (key, tie) of the q-th smallest row; ``quota`` has (*parts, q).

    Rows with (key, tie) <= threshold are exactly the first q rows of their part.
    Parts with q <= 0 get no threshold row. All tables joined here have one row per
    part or per (part, bucket) and are bounded independently of the data size.
    """
    parts = list(parts)
    b = F.substring(F.col(key), 1, hex_digits)
    counts = df.groupBy(*parts, b.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*parts).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = (
        counts.withColumn("_cum", F.sum("_n").over(w))
        .withColumn("_tot", F.sum("_n").over(Window.partitionBy(*parts)))
        .join(F.broadcast(quota.filter(F.col("q") > 0)), parts)
        .withColumn("_q", F.least(F.col("q"), F.col("_tot")))
    )
    bnd = (
        cum.filter(F.col("_cum") >= F.col("_q"))
        .groupBy(*parts)
        .agg(F.min(F.struct("_b", (F.col("_q") - F.col("_cum") + F.col("_n")).alias("_r"))).alias("_m"))
        .select(*parts, F.col("_m._b").alias("_b"), F.col("_m._r").alias("_r"))
    )
    cand = df.withColumn("_b", b).join(F.broadcast(bnd), parts + ["_b"])
    rw = Window.partitionBy(*parts).orderBy(F.col(key), F.col(tie))
    return (
        cand.withColumn("_rn", F.row_number().over(rw))
        .filter(F.col("_rn") == F.col("_r"))
        .select(*parts, F.col(key).alias("_thr_key"), F.col(tie).alias("_thr_tie"))
    )


def cut_threshold(df: DataFrame, key: str, tie: str, q: Column, hex_digits: int = 4) -> tuple[Column, Column]:
    """Global variant: scalar-subquery columns (threshold key, threshold tie) of the
    q-th smallest row. The bucket table (<= 16^hex_digits rows) and the boundary
    bucket are the only things ranked."""
    b = F.substring(F.col(key), 1, hex_digits)
    counts = df.groupBy(b.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    tot = counts.select(F.sum("_n")).scalar()
    qq = F.least(q, tot)
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bnd = (
        counts.withColumn("_cum", F.sum("_n").over(w))
        .filter((F.col("_cum") >= qq) & (qq > 0))
        .agg(F.min(F.struct("_b", (qq - F.col("_cum") + F.col("_n")).alias("_r"))).alias("_m"))
    )
    bb = bnd.select("_m._b").scalar()
    r = bnd.select("_m._r").scalar()
    cand = (
        df.filter(b == bb)
        .withColumn("_rn", F.row_number().over(Window.orderBy(F.col(key), F.col(tie))))
        .filter(F.col("_rn") == r)
    )
    return cand.select(F.col(key)).scalar(), cand.select(F.col(tie)).scalar()


def _below(key: str, tie: str, thr_key: Column | None = None, thr_tie: Column | None = None) -> Column:
    k, t = F.col(key), F.col(tie)
    tk = F.col("_thr_key") if thr_key is None else thr_key
    tt = F.col("_thr_tie") if thr_tie is None else thr_tie
    return F.coalesce((k < tk) | ((k == tk) & (t <= tt)), F.lit(False))


def test_quotas(df: DataFrame, test_size: float = 0.2, label_col: str = "label") -> DataFrame:
    """(label, n, q): per-label test quota of a stratified split.

    n_test = ceil(test_size * n); the train side is allocated proportionally with
    largest remainders (ties: label order), test = count - train allocation.
    Integer arithmetic only; the table has one row per label.
    """
    if not 0 < test_size < 1:
        raise SplitError("test_size must be in (0, 1)")
    c = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("c"))
    allw = Window.partitionBy()
    c = c.withColumn("n", F.sum("c").over(allw))
    c = c.withColumn("nt", F.ceil(F.lit(float(test_size)) * F.col("n")).cast("long"))
    c = c.withColumn("ntr", F.col("n") - F.col("nt"))
    c = c.withColumn("base", F.expr("(c * ntr) div n").cast("long"))
    c = c.withColumn("rem", (F.col("c") * F.col("ntr")) % F.col("n"))
    c = c.withColumn("short", F.col("ntr") - F.sum("base").over(allw))
    c = c.withColumn("rk", F.row_number().over(Window.orderBy(F.desc("rem"), F.asc("label"))))
    train = F.col("base") + F.when(F.col("rk") <= F.col("short"), 1).otherwise(0)
    return c.select("label", F.col("c").alias("n"), (F.col("c") - train).alias("q"))


def stratified_split(df: DataFrame, *, test_size: float = 0.2, seed: int = 42, label_col: str = "label",
                     id_col: str = "row_id") -> DataFrame:
    """Add ``split`` in {train, test}: per label, the first q rows in md5(seed:row_id) order."""
    keyed = df.withColumn("_key", md5_order(seed, id_col))
    quota = test_quotas(df, test_size, label_col).select(F.col("label").alias(label_col), "q")
    thr = cut_thresholds(keyed, "_key", id_col, quota, [label_col])
    return (
        keyed.join(F.broadcast(thr), label_col, "left")
        .withColumn("split", F.when(_below("_key", id_col), "test").otherwise("train"))
        .drop("_key", "_thr_key", "_thr_tie")
    )


def grouped_split_once(df: DataFrame, *, test_size: float = 0.2, seed: int = 42,
                       text_col: str = "text") -> DataFrame:
    """Whole text groups go to one side: the first ceil(test_size * groups) groups in
    md5(seed:text) order are test. The group key is the md5 itself, so rows are
    assigned by comparing with one scalar threshold - no join on the text. The texts are
    read for the keys, which go to a table in the shared folder, and for the assignment."""
    keys = on_files(df.select(md5_order(seed, text_col).alias("_key")), "split-keys")
    return _with_split(df, keys, md5_order(seed, text_col), test_size)


def _with_split(df: DataFrame, keys: DataFrame, key: Column, test_size: float) -> DataFrame:
    """``df`` with its side, by the cut through the different values of ``keys._key``; ``key`` is a row's own."""
    groups = keys.select("_key").distinct().withColumn("_tie", F.lit(0))
    n_groups = groups.select(F.count(F.lit(1))).scalar()
    tk, tt = cut_threshold(groups, "_key", "_tie", F.ceil(F.lit(float(test_size)) * n_groups))
    return (
        df.withColumn("_key", key).withColumn("_tie", F.lit(0))
        .withColumn("split", F.when(_below("_key", "_tie", tk, tt), "test").otherwise("train"))
        .drop("_key", "_tie")
    )


def grouped_split(df: DataFrame, *, test_size: float = 0.2, seed: int = 42, retries: int = 50,
                  labels: Sequence[str] = DEFAULT_LABELS, text_col: str = "text",
                  label_col: str = "label") -> tuple[DataFrame, int]:
    """Duplicate-safe split; retries seeds seed..seed+retries-1 until both sides hold
    every label (one pass over the texts per attempt, for a table of keys and labels). Returns
    (split df, seed used)."""
    for offset in range(retries):
        s = seed + offset
        keys = on_files(df.select(md5_order(s, text_col).alias("_key"), F.col(label_col).alias("_label")), "split-keys")
        cover = _with_split(keys, keys, F.col("_key"), test_size).groupBy("split").agg(
            *[F.max((F.col("_label") == lab).cast("int")).alias(f"has_{i}") for i, lab in enumerate(labels)]
        ).collect()
        sides = {r["split"]: all(r[f"has_{i}"] == 1 for i in range(len(labels))) for r in cover}
        if sides.get("train") and sides.get("test"):
            return _with_split(df, keys, md5_order(s, text_col), test_size), s
    raise SplitError(f"no seed from {seed} to {seed + retries - 1} puts every label on both sides of a split by text")


def split_leakage(split_df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: duplicates in the corpus and text overlap between train and test."""
    g = split_df.groupBy(text_key(text_col).alias("_h")).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.max((F.col("split") == "train").cast("int")).alias("in_train"),
        F.max((F.col("split") == "test").cast("int")).alias("in_test"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    )
    both = (F.col("in_train") == 1) & (F.col("in_test") == 1)
    return g.agg(
        F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))), F.lit(0)).cast("long").alias("duplicate_message_rows"),
        F.count_if(F.col("cnt") > 1).alias("duplicate_message_groups"),
        F.count_if(both).alias("text_overlap_count"),
        F.coalesce(F.sum(F.when(both, F.col("test_rows"))), F.lit(0)).cast("long").alias("test_rows_with_train_text"),
    )


def split_profile(split_df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS, text_col: str = "text",
                  label_col: str = "label") -> DataFrame:
    """One row: rows, distinct texts and class counts per side, and text overlap."""
    g = split_df.groupBy(text_key(text_col).alias("_h")).agg(
        F.max((F.col("split") == "train").cast("int")).alias("in_train"),
        F.max((F.col("split") == "test").cast("int")).alias("in_test"),
    )
    texts = g.agg(
        F.count_if(F.col("in_train") == 1).alias("train_unique_texts"),
        F.count_if(F.col("in_test") == 1).alias("test_unique_texts"),
        F.count_if((F.col("in_train") == 1) & (F.col("in_test") == 1)).alias("text_overlap_count"),
    )
    cols = [
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    ]
    for side in ("train", "test"):
        for lab in labels:
            cols.append(F.count_if((F.col("split") == side) & (F.col(label_col) == lab)).alias(f"{side}_{lab}"))
    out = split_df.agg(*cols).withColumn("_t", texts.select(F.struct(*texts.columns)).scalar())
    return out.select("*", "_t.*").drop("_t")


def class_weights(df: DataFrame, label_col: str = "label", out: str = "weight") -> DataFrame:
    """Balanced weights n / (K * n_c) joined onto every row (table bounded by #labels)."""
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    allw = Window.partitionBy()
    w = c.select(
        label_col,
        (F.sum("_nc").over(allw) / (F.count(F.lit(1)).over(allw) * F.col("_nc"))).alias(out),
    )
    return df.join(F.broadcast(w), label_col)


def sample_messages(df: DataFrame, k: int, *, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Seeded sample without replacement of min(k, n) rows, ordered by row_id."""
    if k < 2:
        raise SplitError(f"a sample of {k} rows was asked for; 2 is the least")
    keyed = df.withColumn("_key", md5_order(seed, id_col))
    tk, tt = cut_threshold(keyed, "_key", id_col, F.lit(k).cast("long"))
    return keyed.filter(_below("_key", id_col, tk, tt)).drop("_key").orderBy(id_col)
