"""Corpus analytics: word, vocabulary, term-score and n-gram statistics.

Plan shape shared by every operator here:

1. tokenize (narrow projection, regex in the JVM),
2. explode every token, and every different token of a row once more, and ``groupBy(token)``
   over primitive columns: partial aggregation on the map side, so even a token present in
   every message costs one row per map partition in the shuffle,
3. corpus totals as scalar subqueries (computed once, shared exchange), per-label
   totals as a join against a table bounded by the number of wanted labels.

"First seen" tie-breaks use (row_id, place in the row): corpus order is row order, i.e.
ascending ``row_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgsift.functions.labels import DEFAULT_LABELS
from msgsift.functions.text import counted, make_ngrams, occurrences, tokenize
from msgsift.operators._util import label_order, pct, top_n_ranked
from msgsift.session import on_files


class TextAnalysisError(ValueError):
    """Raised when analysis parameters are invalid."""


def with_tokens(messages: DataFrame, *, text_col: str = "text", out: str = "tokens", **opts) -> DataFrame:
    """Add the ordered token array (see :func:`msgsift.functions.tokenize`)."""
    return messages.withColumn(out, tokenize(F.col(text_col), **opts))


def require_tokens(df: DataFrame, labels: Sequence[str] = (), tokens_col: str = "tokens") -> None:
    """Raise unless the corpus, and each of ``labels``, has a token. Reads up to the first one only."""
    some = df.where(F.size(tokens_col) > 0)
    empty = [lab for lab in labels if some.where(F.col("label") == lab).isEmpty()]
    if len(empty) == len(labels) and some.isEmpty():
        raise TextAnalysisError("the messages hold no token")
    if empty:
        raise TextAnalysisError(f"no token in messages labelled {empty}")


def exploded_tokens(df: DataFrame, tokens_col: str = "tokens", keys: Sequence[str] = ()) -> DataFrame:
    """(*keys, token): one row per token."""
    return df.select(*keys, F.explode_outer(tokens_col).alias("token")).where(F.col("token").isNotNull())


def token_statistics(df: DataFrame, tokens_col: str = "tokens", keys: Sequence[str] = ()) -> DataFrame:
    """(*keys, token, count, document_count, first_seen) over all rows."""
    return counted(occurrences(df, {1: tokens_col}, keys), [*keys, "token"])


def corpus_stats(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """One row: total_messages, messages_with_tokens, total_tokens, unique_tokens."""
    unique = exploded_tokens(df, tokens_col).distinct().select(F.count(F.lit(1))).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.size(tokens_col) > 0).alias("messages_with_tokens"),
        F.coalesce(F.sum(F.size(tokens_col)), F.lit(0)).cast("long").alias("total_tokens"),
    ).withColumn("unique_tokens", unique)


def token_sketches(df: DataFrame, keys: Sequence[str], *, tokens_col: str = "tokens", lg_k: int = 12) -> DataFrame:
    """(*keys, messages, tokens, sketch): one mergeable HLL sketch of the distinct tokens per group.

    Stored, the table answers the unique tokens of any union of groups (``merged_unique_tokens``)
    without the corpus. A token of every message is one update per task; a sketch takes at most
    2^lg_k bytes or so, with a relative standard error of about 0.83 / sqrt(2^lg_k) (1.3 % at 12).
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"), F.coalesce(F.sum(F.size(tokens_col)), F.lit(0)).cast("long").alias("tokens"))
    made = exploded_tokens(df, tokens_col, keys).groupBy(*keys).agg(F.hll_sketch_agg("token", F.lit(lg_k)).alias("sketch"))
    renamed = made.select(*[F.col(k).alias(f"_{k}") for k in keys], "sketch")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return sizes.join(renamed, cond, "left").drop(*[f"_{k}" for k in keys])


def merged_unique_tokens(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, messages, tokens, unique_tokens): the groups of stored sketches merged; the last is an estimate."""
    g = sketches.groupBy(*by) if by else sketches.groupBy()
    estimate = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("long")
    return g.agg(F.coalesce(F.sum("messages"), F.lit(0)).cast("long").alias("messages"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens"),
                 estimate.alias("unique_tokens"))


def _totals(stats: DataFrame):
    """One scalar subquery over the aggregated token table that references every
    aggregated column, so column pruning leaves its partial aggregate identical to the
    main plan's and the shuffle is reused instead of recomputed."""
    return stats.select(F.struct(
        F.sum("count").alias("tokens"),
        F.sum("document_count").alias("pairs"),
        F.min("first_seen").alias("first"),
    )).scalar()


def frequent_words(df: DataFrame, top_n: int = 50, tokens_col: str = "tokens") -> DataFrame:
    """Top-N tokens by count, ties by first occurrence in corpus order.

    percentage is against all tokens; document_percentage against all messages
    (messages without tokens count in the denominator).
    """
    if top_n < 1:
        raise TextAnalysisError(f"top_n is {top_n}; it counts rows from 1")
    require_tokens(df, tokens_col=tokens_col)
    stats = token_statistics(df, tokens_col)
    total_tokens = _totals(stats)["tokens"]
    total_messages = df.select(F.count(F.lit(1))).scalar()
    ranked = top_n_ranked(stats, [F.desc("count"), F.asc("first_seen")], top_n)
    return ranked.select(
        F.col("rank").cast("int").alias("rank"),
        "token",
        F.col("count").cast("long").alias("count"),
        pct(F.col("count"), total_tokens).alias("percentage"),
        F.col("document_count").cast("long").alias("document_count"),
        pct(F.col("document_count"), total_messages).alias("document_percentage"),
    )


def label_token_totals(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(label, messages, tokens): one row per label present."""
    return df.groupBy("label").agg(
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.size(tokens_col)), F.lit(0)).cast("long").alias("tokens"),
    )


def vocabulary_by_label(
    df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS, tokens_col: str = "tokens"
) -> DataFrame:
    """Every token of every label with per-label percentages.

    Ordered by label (given order), count desc, first occurrence within the label.
    The per-label totals table has one row per label (bounded) and is broadcast.
    """
    wanted = df.filter(F.col("label").isin(list(labels)))
    stats = token_statistics(wanted, tokens_col, keys=["label"])
    totals = label_token_totals(wanted, tokens_col)
    out = stats.join(F.broadcast(totals), "label").select(
        "label",
        "token",
        F.col("count").cast("long").alias("count"),
        pct(F.col("count"), F.col("tokens")).alias("percentage"),
        F.col("document_count").cast("long").alias("document_count"),
        pct(F.col("document_count"), F.col("messages")).alias("document_percentage"),
        "first_seen",
    )
    return out.orderBy(label_order(labels), F.desc("count"), F.asc("first_seen")).drop("first_seen")


def vocabulary_overlap(
    df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS, tokens_col: str = "tokens"
) -> DataFrame:
    """One row: size of the union and of the intersection of the label vocabularies."""
    a, b = labels[0], labels[1]
    per_token = exploded_tokens(df, tokens_col, keys=["label"]).groupBy("token").agg(
        F.max((F.col("label") == a).cast("int")).alias("in_a"),
        F.max((F.col("label") == b).cast("int")).alias("in_b"),
    )
    return per_token.agg(
        F.count_if((F.col("in_a") == 1) | (F.col("in_b") == 1)).alias("total_vocabulary_size"),
        F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1)).alias("shared_vocabulary_size"),
        F.count_if(F.col("in_a") == 1).alias(f"{a}_vocabulary_size"),
        F.count_if(F.col("in_b") == 1).alias(f"{b}_vocabulary_size"),
    )


def term_scores(
    df: DataFrame,
    *,
    min_count: int = 1,
    smoothing: float = 0.5,
    positive: str = "spam",
    negative: str = "ham",
    tokens_col: str = "tokens",
) -> DataFrame:
    """Smoothed log-rate ratios of each token between two labels.

    Counts are aligned as a full outer join would (missing = 0) but computed with a
    single conditional aggregation (one shuffle, no join). ``V`` is the size of the
    union vocabulary *before* the ``min_count`` filter.
    """
    if min_count < 1:
        raise TextAnalysisError(f"min_count is {min_count}; it counts occurrences from 1")
    if smoothing <= 0:
        raise TextAnalysisError(f"smoothing is {smoothing}; rates need a positive one")
    p, n = positive, negative
    require_tokens(df, (p, n), tokens_col)
    per_token = (
        exploded_tokens(df.filter(F.col("label").isin(p, n)), tokens_col, keys=["label"])
        .groupBy("token")
        .agg(F.count_if(F.col("label") == p).alias(f"{p}_count"), F.count_if(F.col("label") == n).alias(f"{n}_count"))
    )
    tot = per_token.select(F.struct(
        F.count(F.lit(1)).cast("double").alias("v"),
        F.sum(f"{p}_count").cast("double").alias("tp"),
        F.sum(f"{n}_count").cast("double").alias("tn"),
    )).scalar()
    vocab, t_p, t_n = tot["v"], tot["tp"], tot["tn"]
    s = F.lit(float(smoothing))
    rate_p = (F.col(f"{p}_count") + s) / (t_p + s * vocab)
    rate_n = (F.col(f"{n}_count") + s) / (t_n + s * vocab)
    ratio = F.log(F.col(f"smoothed_{p}_rate") / F.col(f"smoothed_{n}_rate"))
    return (
        per_token.withColumn("total_count", F.col(f"{p}_count") + F.col(f"{n}_count"))
        .filter(F.col("total_count") >= min_count)
        .select(
            "token",
            f"{p}_count",
            f"{n}_count",
            "total_count",
            pct(F.col(f"{p}_count"), t_p).alias(f"{p}_percentage"),
            pct(F.col(f"{n}_count"), t_n).alias(f"{n}_percentage"),
            rate_p.alias(f"smoothed_{p}_rate"),
            rate_n.alias(f"smoothed_{n}_rate"),
        )
        .withColumn(f"log_rate_ratio_{p}_vs_{n}", ratio)
        .withColumn(f"log_rate_ratio_{n}_vs_{p}", -F.col(f"log_rate_ratio_{p}_vs_{n}"))
    )


def typical_terms(
    scores: DataFrame, top_n: int = 30, *, positive: str = "spam", negative: str = "ham"
) -> DataFrame:
    """Top-N terms typical of ``positive``: ratio desc, count desc, token asc; ranked."""
    if top_n < 1:
        raise TextAnalysisError(f"top_n is {top_n}; it counts rows from 1")
    order = [F.desc(f"log_rate_ratio_{positive}_vs_{negative}"), F.desc(f"{positive}_count"), F.asc("token")]
    ranked = top_n_ranked(scores, order, top_n)
    return ranked.select(F.col("rank").cast("int").alias("rank"), *scores.columns)


def _ngram_hash(gram: Column) -> Column:
    return F.xxhash64(gram)


def _ngrams_at(df: DataFrame, n: int, tokens_col: str, keep: Sequence[str]) -> DataFrame:
    """(*keep, pos, n, h, ngram): the n-grams of every row with their places and 64-bit hashes."""
    at = df.select(*keep, F.col(tokens_col).alias("_t"), F.posexplode(tokens_col).alias("pos", "ngram"))
    gram = F.col("ngram")
    for k in range(1, n):
        gram = F.concat_ws(" ", gram, F.get("_t", F.col("pos") + F.lit(k)))
    at = at.where(F.col("pos") + F.lit(n) <= F.size("_t")).select(*keep, "pos", gram.alias("ngram"))
    return at.select(*keep, "pos", F.lit(n).alias("n"), _ngram_hash(F.col("ngram")).alias("h"), "ngram")


def _ngram_candidates(df: DataFrame, sizes: Sequence[int], top_n: int, min_count: int, tokens_col: str) -> DataFrame:
    """(n, h, count, known, row, rank) of the hashes that can hold one of the ``top_n`` n-grams.

    Counted by hash, an aggregate over numbers alone. A hash has at least the count and at most the
    first row of each of its n-grams, so it ranks no lower; hashes tied in the last place all stay.
    """
    hashes = [_ngrams_at(df, n, tokens_col, ["row_id"]).select("n", "h", "row_id") for n in sizes]
    rows = hashes[0]
    for h in hashes[1:]:
        rows = rows.unionAll(h)
    stats = rows.groupBy("n", "h").agg(F.count(F.lit(1)).alias("count"), F.min(F.when(F.col("row_id").isNull(), 0).otherwise(1)).alias("known"),
                                       F.min("row_id").alias("row"))
    w = Window.partitionBy("n").orderBy(F.desc("count"), F.asc("known"), F.asc("row"))
    return stats.where(F.col("count") >= min_count).withColumn("rank", F.rank().over(w)).where(F.col("rank") <= top_n)


def _exact_ngrams(df: DataFrame, sizes: Sequence[int], candidates: DataFrame, tokens_col: str) -> DataFrame:
    """(n, ngram, count, document_count, first_seen) of all n-grams with a hash in ``candidates``."""
    tagged = df.select("row_id", tokens_col, F.monotonically_increasing_id().alias("_r"))
    wanted = F.broadcast(candidates.select("n", "h"))
    found = [_ngrams_at(tagged, n, tokens_col, ["row_id", "_r"]).join(wanted, ["n", "h"]) for n in sizes]
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionAll(f)
    per_row = rows.groupBy("n", "ngram", "_r").agg(F.count(F.lit(1)).alias("c"), F.min("pos").alias("pos"), F.min("row_id").alias("row_id"))
    stats = per_row.groupBy("n", "ngram").agg(F.sum("c").alias("count"), F.count("row_id").alias("document_count"), F.min("row_id").alias("_row"),
                                              F.min_by("pos", "row_id").alias("_pos"))
    return stats.select("n", "ngram", "count", "document_count", F.struct(F.col("_row").alias("row_id"), F.col("_pos").alias("pos")).alias("first_seen"))


def _hash_order(count: int, row) -> tuple:
    return (-count, row is not None, 0 if row is None else row)


def frequent_ngrams(
    df: DataFrame,
    *,
    sizes: Sequence[int] = (2, 3),
    top_n: int = 30,
    min_count: int = 1,
    tokens_col: str = "tokens",
    stored: bool = False,
) -> DataFrame:
    """Top-N n-grams per size with counts, document counts and percentages.

    All n-grams are first counted by a 64-bit hash, then those under the leading hashes by
    themselves. That is exact if ``top_n`` of them rank no lower than the last of these hashes; else
    (n-grams that share a hash) all are counted by themselves. ``stored``: ``df`` is a table on
    files already, so the tokens needn't be written for the passes.
    """
    if top_n < 1:
        raise TextAnalysisError(f"top_n is {top_n}; it counts rows from 1")
    if min_count < 1:
        raise TextAnalysisError(f"min_count is {min_count}; it counts occurrences from 1")
    df = df.select("row_id", tokens_col)
    df = df if stored else on_files(df, "tokens")
    sizes = list(dict.fromkeys(sizes))
    # A row of k tokens has k - n + 1 n-grams, so totals need no n-gram at all.
    totals = df.agg(F.count(F.lit(1)).alias("messages"), *[
        F.coalesce(F.sum(F.greatest(F.size(tokens_col) - F.lit(n - 1), F.lit(0))), F.lit(0)).alias(f"t{n}") for n in sizes]).first()
    n_total = F.element_at(F.create_map(*[F.lit(x) for n in sizes for x in (n, totals[f"t{n}"])]), F.col("n"))
    total_messages = F.lit(totals["messages"])
    candidates = on_files(_ngram_candidates(df, sizes, top_n, min_count, tokens_col), "ngram-hashes")
    # At most top_n hashes and those of one more row that tie with the last.
    stats = on_files(_exact_ngrams(df, sizes, candidates, tokens_col), "ngrams").where(F.col("count") >= min_count)
    w = Window.partitionBy("n").orderBy(F.desc("count"), F.asc("first_seen"))
    last = {r["n"]: (r["hashes"], _hash_order(*r["last"])) for r in candidates.groupBy("n").agg(
        F.count(F.lit(1)).alias("hashes"), F.max_by(F.struct("count", F.when(F.col("known") == 1, F.col("row"))), "rank").alias("last")).collect()}
    leading = stats.withColumn("rank", F.row_number().over(w)).where(F.col("rank") == top_n).collect()
    reached = {r["n"]: _hash_order(r["count"], r["first_seen"]["row_id"]) for r in leading}
    # Fewer hashes than top_n are all hashes there are.
    if any(n not in reached or reached[n] > order for n, (hashes, order) in last.items() if hashes >= top_n):
        base = df
        for n in sizes:
            base = base.withColumn(f"_g{n}", make_ngrams(F.col(tokens_col), n))
        grams = occurrences(base, {n: f"_g{n}" for n in sizes}).withColumnRenamed("token", "ngram")
        stats = counted(grams, ["n", "ngram"]).filter(F.col("count") >= min_count)
    top = stats.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)
    return top.withColumn("n_total", n_total).select(
        F.col("rank").cast("int").alias("rank"),
        F.col("n").cast("int").alias("n"),
        "ngram",
        F.lit("all").alias("label"),
        F.col("count").cast("long").alias("count"),
        pct(F.col("count"), F.col("n_total")).alias("percentage"),
        F.col("document_count").cast("long").alias("document_count"),
        pct(F.col("document_count"), total_messages).alias("document_percentage"),
    )


def report_tables(df: DataFrame, *, top_words: int = 50, top_terms: int = 30, top_ngrams: int = 30, min_count: int = 1,
                  tokens_col: str = "tokens") -> dict[str, DataFrame]:
    """The six report tables: words, vocabulary per label, typical spam and ham terms, bi- and trigrams.
    The tokens and the term scores are written once to the shared folder and read by all of them."""
    df = on_files(df.select("row_id", "label", tokens_col), "report-tokens")
    scores = on_files(term_scores(df, min_count=min_count, tokens_col=tokens_col), "report-scores")
    if scores.isEmpty():
        raise TextAnalysisError(f"no token occurs {min_count} times")
    return {
        "frequent_words": frequent_words(df, top_words, tokens_col),
        "vocabulary_by_label": vocabulary_by_label(df, tokens_col=tokens_col),
        "spam_terms": typical_terms(scores, top_terms),
        "ham_terms": typical_terms(scores, top_terms, positive="ham", negative="spam"),
        "bigrams": frequent_ngrams(df, sizes=(2,), top_n=top_ngrams, tokens_col=tokens_col, stored=True),
        "trigrams": frequent_ngrams(df, sizes=(3,), top_n=top_ngrams, tokens_col=tokens_col, stored=True),
    }
