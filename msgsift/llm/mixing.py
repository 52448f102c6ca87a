"""Mixing sources to target weights by hash-random keys and distributed prefix sums.

The size of a row is its number of words ``[^\\x20\\x09-\\x0D]+``. Sources ordered by code
point (null last) weigh 1, 2, 3, repeating, and share the total of all sizes; a target stops
at ``max_epochs`` times its source's size and the excess is shared again by weight until no
target is above. That fixed point is ``min(cap, lambda * weight)`` for one lambda, which falls
out of prefix sums over the sources sorted by cap / weight; nothing is iterated.

Inside a source the rows are ordered by a hash-random key, range-sorted over all partitions
(so a source with a third of all rows is spread evenly), and a global exclusive prefix sum of
sizes minus the sizes of all sources before gives each row's place. The target is
``epochs * source size + rest``: every row is taken ``epochs`` times, and once more where the
middle of its words lies within ``rest`` - the cut that is nearest to the budget without
splitting a document.

Defined results: null text has size 0; a null source is a source of its own, sorted last; rows
with equal source, id and text share one decision; an empty table gives an empty result; a
corpus without words has targets of 0. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgsift.llm._common import fresh, prefix_sum, shared_table, small_or_shuffled

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    """Each word, with the white space before it, becomes one character; then they are counted."""
    t = F.rtrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(t, r"[ \t-\r]*[^ \t-\r]+", "w")).cast("long")


def hash_key(id_col: Column, text: Column, seed: int) -> Column:
    """128-bit hash-random key: md5 of seed, id and text digest."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")),
                             F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))).cast("binary"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(src, source_size, target, start): ``sources`` has (src, source_size) once per source.

    ``start`` is the sum of the sizes of the sources before it, nulls last. Both passes are
    range-sorted prefix sums, so the number of sources is not limited by one task.
    """
    ordered = sources.withColumn("last", F.col("src").isNull().cast("int")).withColumn("one", F.lit(1).cast("long"))
    numbered = prefix_sum(ordered, ["last", "src"], "one", "rank", "mix-sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    numbered = shared_table(numbered.withColumn("w", w), "mix-weights")
    started = prefix_sum(numbered, ["rank"], "source_size", "start", "mix-starts")
    capped = started.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))).withColumn(
        "ratio", F.col("cap") / F.col("w"))
    caps = prefix_sum(capped, ["ratio", "rank"], "cap", "caps_before", "mix-caps")
    both = prefix_sum(caps, ["ratio", "rank"], "w", "w_before", "mix-lambda")
    both = shared_table(both, "mix-levels")
    total, w_all = both.agg(F.sum("source_size"), F.sum("w")).first()
    # A source is filled to its cap when lambda, computed as if it were the first unfilled one,
    # still exceeds its ratio; the first that is not fixes lambda for all that follow.
    probe = both.withColumn("lam", (F.lit(total) - F.col("caps_before")) / (F.lit(w_all) - F.col("w_before")))
    level = probe.where(F.col("lam") <= F.col("ratio")).agg(F.min(F.struct("ratio", "rank", "lam")).alias("m")).first()["m"]
    if level is None:
        shared = probe.withColumn("target", F.col("cap"))
    else:
        shared = probe.withColumn("target", F.when(F.col("ratio") < F.lit(level["ratio"]), F.col("cap")).otherwise(
            F.least(F.col("cap"), F.lit(level["lam"]) * F.col("w"))))
    return shared.select("src", "source_size", "target", "start")


def decide(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 42) -> DataFrame:
    """One row per distinct (src, id, key): n copies, size, source_size, target, repeats."""
    rows = df.select(
        F.col(source_col).cast("string").alias("src"), F.col(id_col).alias("id"),
        word_count(F.col(text_col)).alias("size"), hash_key(F.col(id_col), F.col(text_col), seed).alias("key"))
    units = shared_table(
        rows.groupBy("src", "id", "key", "size").agg(F.count(F.lit(1)).alias("n")), "mix-units")
    per_source = shared_table(
        units.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "mix-sizes")
    plan = shared_table(targets(per_source, weights, max_epochs), "mix-targets").withColumnRenamed("src", "s")
    sized = units.withColumn("words", F.col("size") * F.col("n")).withColumn("last", F.col("src").isNull().cast("int"))
    placed = prefix_sum(sized, ["last", "src", "key", "id"], "words", "before", "mix-sorted")
    joined = placed.join(small_or_shuffled(plan), F.col("src").eqNullSafe(F.col("s")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    middle = F.col("before") - F.col("start") + F.col("words") / F.lit(2.0)
    extra = ((F.col("words") > 0) & (middle <= rest)).cast("long")
    return joined.select("src", "id", "key", "n", "size", "source_size", "target",
                         (epochs + extra).cast("long").alias("repeats"))


def mix_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 42) -> DataFrame:
    """One row per row of ``df``: doc_id, size, source_size, target, taken (words, repeats counted)."""
    out = decide(df, id_col, text_col, source_col, weights, max_epochs, seed)
    each = out.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("repeats") * F.col("size")).alias("taken"))


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 42,
                  epoch_col: str = "epoch") -> DataFrame:
    """The mix itself: the columns of ``df`` plus ``epoch`` (1, 2, ...); a row is repeated once per
    epoch that takes it and absent when none does."""
    picks = decide(df, id_col, text_col, source_col, weights, max_epochs, seed).where(F.col("repeats") > 0)
    picks = shared_table(picks.select(F.col("key").alias("pk"), F.col("id").alias("pi"),
                                      F.col("src").alias("ps"), F.col("repeats").alias("pr")), "mix-picks")
    names = [fresh(df, s) for s in ("mix_key", "mix_id", "mix_src", "mix_repeats")]
    picks = picks.toDF(*names)
    k, i, s, r = names
    key = hash_key(F.col(id_col), F.col(text_col), seed)
    joined = df.join(small_or_shuffled(picks), (key == F.col(k)) & F.col(id_col).eqNullSafe(F.col(i))
                     & F.col(source_col).cast("string").eqNullSafe(F.col(s)))
    out = epoch_col if epoch_col.lower() not in {c.lower() for c in df.columns} else fresh(df, epoch_col)
    return joined.withColumn(out, F.explode(F.sequence(F.lit(1).cast("long"), F.col(r)))).select(*df.columns, out)


__all__ = ["MAX_EPOCHS", "WEIGHTS", "decide", "hash_key", "mix_documents", "mix_report", "targets", "word_count"]
