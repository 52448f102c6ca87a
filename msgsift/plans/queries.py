"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Every query reads the given tables in full (no id subsets, no row caps). Double
columns whose value depends on summation order or on ``ln``/``sqrt`` are rounded to
9 decimals here and in the oracle, so the two engines compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgsift.functions.labels import normalize_label
from msgsift.functions.text import (
    DEFAULT_STOPWORDS, filter_tokens, make_ngrams, ngram_range_terms, normalize_text, stopword_filter,
    strip_accents, strip_ws, tokenize, word_analyzer,
)
from msgsift.operators import corpus as C
from msgsift.operators import quality as Q
from msgsift.operators import splits as S
from msgsift.operators import evaluate as EV
from msgsift.operators import features as FT
from msgsift.operators import classify as CL
from msgsift.operators import cluster as K
from msgsift.plans.inputs import predictions, split_messages, stored_tokens
from msgsift.operators._util import round_doubles
from msgsift.session import cut_lineage, on_files, scratch_path
from msgsift.sources.tables import conversation_messages, labelled_messages, labelled_raw, raw_messages, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    return C.with_tokens(labelled_messages(spark, sf))


# -- §2.1 / §2.2 scalar functions over whole tables ---------------------------------


@register("normalize_label")
def q_normalize_label(spark, sf):
    labs = read_table(spark, sf, "labels")
    return labs.select(
        F.col("doc_id").cast("long").alias("row_id"),
        F.col("toxic").cast("string").alias("raw_label"),
        normalize_label(F.col("toxic")).alias("label"),
        normalize_label(F.col("quality")).alias("quality_label"),
    )


@register("tokenize")
def q_tokenize(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", tokenize(strip_ws("text")).alias("toks"))
    return docs.select(
        F.col("doc_id").cast("long").alias("row_id"),
        F.size("toks").cast("int").alias("n_tokens"),
        F.size(F.array_distinct("toks")).cast("int").alias("n_distinct"),
        F.coalesce(F.try_element_at("toks", F.lit(1)), F.lit("")).alias("first_token"),
        F.coalesce(F.try_element_at("toks", F.lit(-1)), F.lit("")).alias("last_token"),
        F.md5(F.array_join("toks", " ")).alias("tokens_md5"),
    )


# -- §2.3 corpus analytics -------------------------------------------------------------


@register("frequent_words")
def q_frequent_words(spark, sf):
    return C.frequent_words(_tokens(spark, sf), top_n=50)


@register("corpus_stats")
def q_corpus_stats(spark, sf):
    return C.corpus_stats(_tokens(spark, sf))


@register("label_token_totals")
def q_label_token_totals(spark, sf):
    return C.label_token_totals(_tokens(spark, sf))


@register("vocabulary_by_role")
def q_vocabulary_by_role(spark, sf):
    """The same statistics for the three classes of the conversations."""
    return C.vocabulary_by_label(C.with_tokens(conversation_messages(spark, sf)), labels=("system", "user", "assistant"))


@register("vocabulary_by_label")
def q_vocabulary_by_label(spark, sf):
    return C.vocabulary_by_label(_tokens(spark, sf))


@register("vocabulary_overlap")
def q_vocabulary_overlap(spark, sf):
    return C.vocabulary_overlap(_tokens(spark, sf))


@register("token_sketches")
def q_token_sketches(spark, sf):
    """Unique tokens of every language, label and of all messages, merged from one stored table of
    sketches per language and label; estimates, with the exact numbers of messages and tokens."""
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").cast("long").alias("row_id"), "lang")
    path = scratch_path(spark, "sketches")
    C.token_sketches(_tokens(spark, sf).join(docs, "row_id"), ["lang", "label"]).write.parquet(path)
    stored = spark.read.parquet(path)
    out = C.merged_unique_tokens(stored).select(F.lit("all").alias("part"), F.lit("").alias("value"), "*")
    for key in ("lang", "label"):
        out = out.unionByName(C.merged_unique_tokens(stored, [key]).withColumnRenamed(key, "value").withColumn("part", F.lit(key)))
    return out


@register("term_scores")
def q_term_scores(spark, sf):
    return round_doubles(C.term_scores(_tokens(spark, sf)), 9)


@register("typical_terms_spam")
def q_typical_spam(spark, sf):
    return round_doubles(C.typical_terms(C.term_scores(_tokens(spark, sf)), 30), 9)


@register("typical_terms_ham")
def q_typical_ham(spark, sf):
    scores = C.term_scores(_tokens(spark, sf))
    return round_doubles(C.typical_terms(scores, 30, positive="ham", negative="spam").select(
        "rank", *scores.columns), 9)


@register("frequent_ngrams")
def q_frequent_ngrams(spark, sf):
    return C.frequent_ngrams(_tokens(spark, sf), sizes=(2, 3), top_n=30)


# -- §2.1 quality, duplicates, numbering ------------------------------------------------


@register("row_quality_flags")
def q_row_quality_flags(spark, sf):
    return Q.row_quality_flags(raw_messages(spark, sf)).select(
        "row_id", "missing_label", "missing_text", "invalid_label")


@register("quality_summary")
def q_quality_summary(spark, sf):
    return Q.quality_summary(Q.row_quality_flags(raw_messages(spark, sf)))


def _odd_labels(spark, sf):
    """The raw messages with some labels replaced by unknown ones."""
    odd = F.when(F.col("row_id") % 7 == 0, F.concat(F.lit(" odd"), F.col("row_id") % 5)).when(F.col("row_id") % 11 == 0, F.lit("Toxic?"))
    return raw_messages(spark, sf).withColumn("label", F.coalesce(odd, F.col("label")))


@register("invalid_label_values")
def q_invalid_label_values(spark, sf):
    """Every unknown label value with its rows, over messages with planted labels."""
    return Q.invalid_label_values(Q.row_quality_flags(_odd_labels(spark, sf)))


@register("write_checked")
def q_write_checked(spark, sf):
    """Messages and quarantined rows of one permissive pass, read back with the counts of the pass."""
    from msgsift.sources.sinks import write_checked
    base = scratch_path(spark, "checked")
    facts = write_checked(_odd_labels(spark, sf), f"{base}/messages", f"{base}/quarantine", permissive=True)
    good = spark.read.parquet(f"{base}/messages").select("row_id", F.lit("message").alias("place"), "label", F.md5("text").alias("text_md5"))
    bad = spark.read.parquet(f"{base}/quarantine").select("row_id", F.lit("quarantine").alias("place"), "label", F.md5("text").alias("text_md5"))
    return good.unionByName(bad).withColumn("raw_rows", F.lit(facts["raw_rows"]).cast("long")).withColumn("bad_rows", F.lit(facts["bad_count"]).cast("long"))


@register("normalize_messages")
def q_normalize_messages(spark, sf):
    return Q.normalize_messages(labelled_raw(spark, sf))


@register("assign_row_id")
def q_assign_row_id(spark, sf):
    msgs = labelled_messages(spark, sf).withColumnRenamed("row_id", "doc_id")
    return Q.assign_row_id(msgs, ["doc_id"]).select("row_id", "doc_id", "label")


@register("duplicate_rows")
def q_duplicate_rows(spark, sf):
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").cast("long").alias("row_id"),
                                                     strip_ws("text").alias("text"))
    return Q.duplicate_rows(docs).select("row_id", F.length("text").alias("n_chars"))


@register("duplicate_stats")
def q_duplicate_stats(spark, sf):
    return Q.duplicate_stats(labelled_messages(spark, sf))


@register("dedup_keep_first")
def q_dedup_keep_first(spark, sf):
    return Q.dedup_keep_first(labelled_messages(spark, sf)).select(
        "row_id", "source_row_id", "label", F.length("text").alias("n_chars"))


@register("label_counts")
def q_label_counts(spark, sf):
    return Q.label_counts(labelled_messages(spark, sf))


@register("validation_summary")
def q_validation_summary(spark, sf):
    return Q.validation_counts(labelled_raw(spark, sf), drop_duplicates=True)


# -- §2.5 splits ---------------------------------------------------------------------------


@register("stratified_split")
def q_stratified_split(spark, sf):
    return split_messages(spark, sf, "row").select("row_id", "label", "split")


@register("grouped_split")
def q_grouped_split(spark, sf):
    return split_messages(spark, sf, "grouped").select("row_id", "label", "split")


@register("split_leakage")
def q_split_leakage(spark, sf):
    return S.split_leakage(split_messages(spark, sf, "row"))


@register("split_profile")
def q_split_profile(spark, sf):
    return S.split_profile(split_messages(spark, sf, "grouped"))


@register("class_weights")
def q_class_weights(spark, sf):
    return round_doubles(S.class_weights(labelled_messages(spark, sf)).select("row_id", "label", "weight"), 9)


@register("sample_messages")
def q_sample_messages(spark, sf):
    return S.sample_messages(labelled_messages(spark, sf), 100, seed=42).select("row_id", "label")


# -- §2.6 evaluation (deterministic log-ratio predictions) ------------------------------


def _pred(spark, sf, strategy="row", msgs=None):
    # Evaluation reads a materialised predictions table (as the stage boundary does
    # in the batch flow): a reliable checkpoint in spark.checkpoint.dir.
    # No metric reads the texts, so they stay out of it.
    return cut_lineage(EV.prediction_table(predictions(spark, sf, strategy, text=False, msgs=msgs)))


def _runs(spark, sf):
    """Predictions of both strategies, from messages that are read and cut into tokens once."""
    msgs = stored_tokens(spark, sf)
    return {"row_stratified_split": _pred(spark, sf, "row", msgs), "group_shuffle_split_by_text": _pred(spark, sf, "grouped", msgs)}


@register("prediction_table")
def q_prediction_table(spark, sf):
    return _pred(spark, sf).drop("text")


@register("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(_pred(spark, sf))


@register("binary_metrics")
def q_binary_metrics(spark, sf):
    return round_doubles(EV.binary_metrics(_pred(spark, sf)), 9)


@register("averaged_metrics")
def q_averaged_metrics(spark, sf):
    return round_doubles(EV.averaged_metrics(_pred(spark, sf)), 9)


@register("classification_report")
def q_classification_report(spark, sf):
    return round_doubles(EV.classification_report(_pred(spark, sf)), 9)


@register("evaluation_comparison")
def q_evaluation_comparison(spark, sf):
    runs = _runs(spark, sf)
    return round_doubles(EV.evaluation_comparison(runs), 9)


@register("error_examples")
def q_error_examples(spark, sf):
    return round_doubles(EV.error_examples(_pred(spark, sf)).drop("text"), 9)


@register("pr_curve")
def q_pr_curve(spark, sf):
    return round_doubles(EV.pr_curve(_pred(spark, sf)), 9)


@register("average_precision")
def q_average_precision(spark, sf):
    return round_doubles(EV.average_precision(_pred(spark, sf)), 9)


@register("prevalence")
def q_prevalence(spark, sf):
    return round_doubles(EV.prevalence(_pred(spark, sf)), 9)


@register("confusion_rates")
def q_confusion_rates(spark, sf):
    return round_doubles(EV.confusion_rates(_pred(spark, sf)), 9)


# -- §2.2 more text functions over all documents -------------------------------------


def _docs(spark, sf):
    return read_table(spark, sf, "documents").select(F.col("doc_id").cast("long").alias("row_id"), "text")


def _arr_summary(df, col):
    return df.select(
        "row_id",
        F.size(col).cast("int").alias("n"),
        F.md5(F.array_join(col, " ")).alias("md5"),
    )


@register("normalize_text")
def q_normalize_text(spark, sf):
    d = _docs(spark, sf)
    return d.select("row_id", F.md5(normalize_text(F.col("text"))).alias("md5"),
                    F.length(normalize_text(F.col("text"), lowercase=False)).cast("int").alias("n_chars"))


@register("filter_tokens")
def q_filter_tokens(spark, sf):
    d = _docs(spark, sf).withColumn("t", tokenize(F.col("text"), filter_numeric_only=False))
    d = d.withColumn("f", filter_tokens(F.col("t"), min_token_length=3, remove_stopwords=True))
    return _arr_summary(d, "f")


@register("stopword_filter")
def q_stopword_filter(spark, sf):
    d = _docs(spark, sf).withColumn("t", tokenize(F.col("text")))
    return _arr_summary(d.withColumn("f", stopword_filter(F.col("t"), DEFAULT_STOPWORDS)), "f")


@register("make_ngrams")
def q_make_ngrams(spark, sf):
    d = _docs(spark, sf).withColumn("t", tokenize(F.col("text")))
    return _arr_summary(d.withColumn("g", make_ngrams(F.col("t"), 3)), "g")


@register("strip_accents")
def q_strip_accents(spark, sf):
    d = _docs(spark, sf)
    return d.select("row_id", F.md5(strip_accents(F.lower(F.col("text")))).alias("md5"))


@register("word_analyzer")
def q_word_analyzer(spark, sf):
    d = _docs(spark, sf).withColumn("w", word_analyzer(F.col("text")))
    return _arr_summary(d, "w")


@register("ngram_range_terms")
def q_ngram_range_terms(spark, sf):
    d = _docs(spark, sf).withColumn("w", word_analyzer(F.col("text")))
    return _arr_summary(d.withColumn("g", ngram_range_terms(F.col("w"), max_n=2)), "g")


# -- §2.4 features ----------------------------------------------------------------------


def _terms(spark, sf):
    return FT.with_terms(labelled_messages(spark, sf))


@register("build_vocabulary")
def q_build_vocabulary(spark, sf):
    return round_doubles(FT.build_vocabulary(_terms(spark, sf), min_df=2).drop("n_docs"), 9)


@register("build_vocabulary_limited")
def q_build_vocabulary_limited(spark, sf):
    return round_doubles(FT.build_vocabulary(_terms(spark, sf), min_df=2, max_features=5000).drop("n_docs"), 9)


def _stored_terms(spark, sf):
    """(row_id, terms) for several passes: the texts lie on files, a third as large as their terms."""
    return FT.with_terms(on_files(labelled_messages(spark, sf).select("row_id", "text"), "texts")).select("row_id", "terms")


@register("tfidf_weights")
def q_tfidf_weights(spark, sf):
    terms = _stored_terms(spark, sf)
    vocab = FT.build_vocabulary(terms, min_df=2)
    return round_doubles(FT.tfidf_transform(terms, vocab).select("row_id", "term", "weight"), 9)


@register("tfidf_transform")
def q_tfidf_transform(spark, sf):
    vocab = FT.build_vocabulary(_terms(spark, sf), min_df=2)
    bench = FT.with_terms(read_table(spark, sf, "benchmark").select(
        F.col("item_id").cast("long").alias("row_id"), "text"))
    return round_doubles(FT.tfidf_transform(bench, vocab).select("row_id", "term", "weight"), 9)


@register("assemble_sparse")
def q_assemble_sparse(spark, sf):
    from pyspark.ml.feature import Normalizer
    terms = _stored_terms(spark, sf)
    vocab = on_files(FT.build_vocabulary(terms, min_df=2), "vocabulary")
    # On files the shuffles that the entries came by are gone before the rows are put together.
    entries = on_files(FT.tfidf_transform(terms, vocab, term=False), "entries")
    vec = FT.assemble_sparse(FT.to_sparse_rows(entries, vocab.count()))
    # The vectors are read by an ML stage; their unit norm must survive it.
    back = FT.sparse_entries(Normalizer(inputCol="features", outputCol="unit").transform(vec), "unit")
    return back.select("row_id", F.size("indices").cast("int").alias("nnz"), F.col("size").cast("int").alias("size"),
                       F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x * x), 6).alias("sq_norm"))


@register("l2_normalize")
def q_l2_normalize(spark, sf):
    e = read_table(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    n = FT.with_l2_normalized(e, "embedding", "unit")
    return round_doubles(n.select("vec_id", F.posexplode("unit").alias("dim", "value")), 9)


@register("lsa_embed")
def q_lsa_embed(spark, sf):
    """Sign-free properties of the embeddings: the size and length of each row's vector, and for
    the whole table the number of components that are orthogonal to each other."""
    emb, meta = FT.lsa_embed(labelled_messages(spark, sf), stopwords=sorted(DEFAULT_STOPWORDS))
    sq = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return emb.select("row_id", F.size("embedding").alias("dims"), F.round(sq, 4).alias("sq_norm")).withColumn(
        "components", F.lit(meta["components"])).withColumn(
        "singular_values_fall", F.lit(all(a >= b for a, b in zip(meta["singular_values"], meta["singular_values"][1:]))))


@register("batch_embed")
def q_batch_embed(spark, sf):
    return FT.batch_embed(_docs(spark, sf), FT.md5_embedder(64), batch_size=64).select(
        "row_id", F.posexplode("embedding").alias("dim", "value")).where("value <> 0").select(
        "row_id", F.col("dim").cast("int").alias("dim"), F.col("value").cast("double").alias("value"))


# -- §2.5 classifier --------------------------------------------------------------------


def fixed_classifier(spark, sf):
    """A classifier with given weights: the vocabulary of the labelled messages and coefficients
    that follow from each term's md5, so that scoring can be checked without a fit."""
    vocab = FT.build_vocabulary(_stored_terms(spark, sf), min_df=2)
    low = F.conv(F.substring(F.md5("term"), 1, 4), 16, 10).cast("long")
    weights = vocab.select("idx", "term", "idf", ((low % 2001 - 1000) / F.lit(1000.0)).alias("coefficient"))
    return CL.TextClassifier(on_files(weights, "weights"), -0.25)


def _stored_split(spark, sf):
    """The row split of the messages, on files once for both sides."""
    return on_files(split_messages(spark, sf, "row").select("row_id", "label", "text", "split"), "split")


def _side(split, name):
    return split.filter(F.col("split") == name).select("row_id", "label", "text")


@register("fit_classifier")
def q_fit_classifier(spark, sf):
    train = _side(_stored_split(spark, sf), "train")
    return CL.fit_report(CL.fit_classifier(train), train)


@register("score_messages")
def q_score_messages(spark, sf):
    test = cut_lineage(split_messages(spark, sf, "row").filter(F.col("split") == "test").select("row_id", "label", "text"))
    scored = CL.score_messages(fixed_classifier(spark, sf), test)
    return round_doubles(scored.join(test.select("row_id", F.col("label").alias("true_label")), "row_id"), 9)


@register("predict_confidence")
def q_predict_confidence(spark, sf):
    bench = read_table(spark, sf, "benchmark").select(F.col("item_id").cast("long").alias("row_id"), "text")
    return round_doubles(CL.predict_confidence(fixed_classifier(spark, sf), bench), 9)


def _fitted(spark, sf):
    """(the classifier fitted on the training side of the row split, the test side)."""
    sp = _stored_split(spark, sf)
    return CL.fit_classifier(_side(sp, "train")), _side(sp, "test")


@register("fit_then_score")
def q_fit_then_score(spark, sf):
    """Fit on the training rows, score the test rows."""
    clf, test = _fitted(spark, sf)
    return CL.score_messages(clf, test).join(test.select("row_id", F.col("label").alias("true_label")), "row_id")


@register("fit_then_predict")
def q_fit_then_predict(spark, sf):
    """Label and confidence of every benchmark text by the fitted classifier."""
    clf, _ = _fitted(spark, sf)
    bench = read_table(spark, sf, "benchmark").select(F.col("item_id").cast("long").alias("row_id"), "text")
    return CL.predict_confidence(clf, bench)


@register("fit_then_load")
def q_fit_then_load(spark, sf):
    """The classifier as an ML pipeline: fitted, saved, loaded again, and applied to the test rows."""
    from pyspark.ml import Pipeline, PipelineModel

    from msgsift.operators.stage import TextClassifierStage
    sp = _stored_split(spark, sf)
    path = scratch_path(spark, "pipeline-model")
    Pipeline(stages=[TextClassifierStage()]).fit(_side(sp, "train")).save(path)
    return PipelineModel.load(path).transform(sp.filter(F.col("split") == "test")).select(
        "row_id", "predicted_label", "spam_probability", F.col("label").alias("true_label"))


@register("fit_then_stream")
def q_fit_then_stream(spark, sf):
    """All documents arrive as a file stream and are scored by the fitted classifier."""
    from msgsift.streaming.score import read_scores, stream_score
    clf, _ = _fitted(spark, sf)
    base = scratch_path(spark, "fit-stream")
    q = stream_score(clf, _text_stream(spark, sf, "documents", "doc_id", "doc-"), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    return read_scores(spark, f"{base}/out")


@register("training_metadata")
def q_training_metadata(spark, sf):
    return CL.training_metadata(split_messages(spark, sf, "row"))


@register("corpus_fingerprint")
def q_corpus_fingerprint(spark, sf):
    return CL.corpus_fingerprint(labelled_messages(spark, sf))


@register("fingerprint_tree")
def q_fingerprint_tree(spark, sf):
    """Every node of the corpus's digest tree."""
    from msgsift.operators.merkle import digest_tree
    return digest_tree(labelled_messages(spark, sf))


@register("fingerprint_difference")
def q_fingerprint_difference(spark, sf):
    """The leaves in which the corpus differs from one with changed, added and removed rows, found by
    descending two stored trees."""
    from msgsift.operators.merkle import differing_leaves, digest_tree, write_tree
    base = scratch_path(spark, "trees")
    one = cut_lineage(labelled_messages(spark, sf))
    text = F.when(F.col("row_id") % 97 == 0, F.concat("text", F.lit(" changed"))).otherwise(F.col("text"))
    other = one.where(F.col("row_id") % 89 != 0).withColumn("text", text)
    other = other.unionByName(one.where(F.col("row_id") % 83 == 0).withColumn("text", F.lit("added")))
    write_tree(digest_tree(one), f"{base}/one")
    write_tree(digest_tree(other), f"{base}/other")
    return differing_leaves(spark, f"{base}/one", f"{base}/other")


# -- §2.7 clustering ----------------------------------------------------------------------


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("long").alias("row_id"), "embedding", F.col("label").cast("int").alias("given"))


@register("nearest_centroid")
def q_nearest_centroid(spark, sf):
    e = _emb(spark, sf)
    cents = K.label_centroids(e, "given")
    return round_doubles(K.nearest_centroid(e, cents).select("row_id", "given", "cluster_id", "distance_to_centroid"), 9)


@register("silhouette")
def q_silhouette(spark, sf):
    return round_doubles(K.silhouette_table(_emb(spark, sf), prediction="given"), 9)


@register("kmeans_fit")
def q_kmeans_fit(spark, sf):
    """What every finished fit satisfies: all clusters are used, each row's cluster is the one of its
    nearest centre, and each centre is the mean of its rows (the fit is a fixed point)."""
    e = K.with_vector(_emb(spark, sf))
    model = K.kmeans_fit(e, 10, seed=42, n_init=20)
    rows = cut_lineage(model.transform(e).select("row_id", "embedding", F.col("prediction").alias("given")))
    centres = K.label_centroids(rows, "given")
    near = K.nearest_centroid(rows, centres)
    return near.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("given").alias("clusters"),
                    F.count_if(F.col("cluster_id") != F.col("given")).alias("not_nearest"))


@register("select_k")
def q_select_k(spark, sf):
    """The facts of ``silhouette_by_k`` that SQL can state: the tried cluster counts with whether each
    silhouette is a proper one, and one best."""
    return K.select_k_table(K.with_vector(_emb(spark, sf)), "auto", seed=42).select(
        "k", F.col("silhouette").between(-1, 1).alias("proper"), F.sum(F.col("best").cast("int")).over(
            Window.partitionBy()).alias("bests"))


@register("silhouette_by_k")
def q_silhouette_by_k(spark, sf):
    """(k, silhouette, best) for each cluster count tried."""
    return K.select_k_table(K.with_vector(_emb(spark, sf)), "auto", seed=42)


@register("project_2d")
def q_project_2d(spark, sf):
    """Sign-free: squared coordinates are summed, so are the products of the two axes."""
    pts = K.project_2d(K.with_vector(_emb(spark, sf)))
    return pts.agg(F.count(F.lit(1)).alias("rows"), F.round(F.abs(F.avg("x")), 6).alias("mean_x"), F.round(F.abs(F.avg("y")), 6).alias("mean_y"),
                   F.round(F.abs(F.avg(F.col("x") * F.col("y"))), 6).alias("cross_xy"), (F.var_pop("x") >= F.var_pop("y")).alias("ordered"))


def _lang_clusters(spark, sf):
    """A given clustering of the labelled messages: cluster = language (dense index in
    language order), distance = |length - cluster mean length| / mean length.
    The per-language table is bounded by the number of languages (broadcast)."""
    msgs = labelled_messages(spark, sf)
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").cast("long").alias("row_id"), "lang")
    m = msgs.join(docs, "row_id").withColumn("n", F.length("text").cast("double"))
    langs = m.groupBy("lang").agg(F.avg("n").alias("mean_n"))
    langs = langs.withColumn("cluster_id", (F.dense_rank().over(Window.orderBy("lang")) - 1).cast("int"))
    return m.join(F.broadcast(langs), "lang").withColumn(
        "distance_to_centroid", F.abs(F.col("n") - F.col("mean_n")) / F.col("mean_n")
    ).select("row_id", "label", "text", "cluster_id", "distance_to_centroid")


@register("cluster_assignments")
def q_cluster_assignments(spark, sf):
    return round_doubles(K.cluster_assignments(_lang_clusters(spark, sf)).drop("text"), 9)


@register("cluster_overview")
def q_cluster_overview(spark, sf):
    return round_doubles(K.cluster_overview(_lang_clusters(spark, sf)), 9)


@register("cluster_representatives")
def q_cluster_representatives(spark, sf):
    return K.cluster_representatives(_lang_clusters(spark, sf), 5).select(
        "cluster_id", "rank", "row_id", "label", F.md5("text").alias("text_md5"))


@register("cluster_theme")
def q_cluster_theme(spark, sf):
    return K.cluster_theme(_lang_clusters(spark, sf))


def _cluster_record(spark, sf):
    return K.cluster_metadata(_emb(spark, sf), provider="given-labels", model="embeddings.label", prediction="given")


@register("cluster_metadata")
def q_cluster_metadata(spark, sf):
    return round_doubles(_cluster_record(spark, sf), 9)


@register("provider_comparison")
def q_provider_comparison(spark, sf):
    out = K.provider_comparison(_cluster_record(spark, sf), ["given-labels", "lsa-local", "remote-embeddings"])
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("embedding_dimensions", "total_messages", "cluster_count")}
    return round_doubles(out.withColumns(shown), 9)


# -- §2.8 streaming re-aims -----------------------------------------------------------------

LIMIT_REQUESTS = 2
LIMIT_WINDOW_S = 6 * 3600.0


@register("rate_limit_decisions")
def q_rate_limit_decisions(spark, sf):
    from msgsift.streaming.ratelimit import rate_limit_decisions
    return rate_limit_decisions(read_table(spark, sf, "events"), requests=LIMIT_REQUESTS,
                                window_seconds=LIMIT_WINDOW_S)


@register("rate_limit_stream")
def q_rate_limit_stream(spark, sf):
    """Same decisions from a Structured Streaming query over several micro-batches: the events
    arrive in four parts in time order, each of as many files as it has partitions; a run takes one
    part and goes on from the checkpoint, so clients' state carries over."""
    from msgsift.streaming.ratelimit import epoch_micros, rate_limit_stream

    events = read_table(spark, sf, "events")
    t = epoch_micros(events, "ts")
    cuts = events.select(F.percentile_approx(t, [0.25, 0.5, 0.75], 1000).alias("c")).first()["c"]
    base = scratch_path(spark, "ratelimit")
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = events if lo is None else events.where(t >= F.lit(lo))
        part = part if hi is None else part.where(t < F.lit(hi))
        part.repartition("user_id").write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        q = (rate_limit_stream(src, requests=LIMIT_REQUESTS, window_seconds=LIMIT_WINDOW_S)
             .writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


#: Events of one micro-batch: a client's share of them is what one task holds.
TRIGGER_EVENTS = 5_000_000
LATENESS_S = 3600


def _limited(spark, sf):
    """Decisions and dead letters of the stateful limiter over all events: they arrive in time order, in
    parts of about ``TRIGGER_EVENTS`` (at least four), but for every 97th event of the first half, which
    comes after all others and so behind the watermark."""
    from msgsift.streaming.limiter_state import rate_limit_stateful, rocksdb_state
    from msgsift.streaming.ratelimit import epoch_micros

    events = read_table(spark, sf, "events")
    t = epoch_micros(events, "ts")
    facts = events.agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi")).first()
    parts = max(4, -(-facts["n"] // TRIGGER_EVENTS))
    cuts = events.select(F.percentile_approx(t, [i / parts for i in range(1, parts)], 20 * parts + 1000).alias("c")).first()["c"] or []
    until = min(((facts["lo"] or 0) + (facts["hi"] or 0)) // 2, (facts["hi"] or 0) - (LATENESS_S * 1_000_000 + 1_000))
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    held_back = (F.col("event_id") % 97 == 0) & (t < F.lit(until))
    part = F.when(held_back, F.lit(parts)).otherwise(F.size(F.filter(bounds, lambda c: c <= t)))
    base = scratch_path(spark, "limiter-state")
    events.withColumn("part", part).repartition("part", "user_id").write.partitionBy("part").parquet(f"{base}/parts")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{base}/in"))
    src = spark.readStream.schema(events.withColumn("part", F.lit(0)).schema).parquet(f"{base}/in")
    with rocksdb_state(spark):
        q = (rate_limit_stateful(src, requests=LIMIT_REQUESTS, window_seconds=LIMIT_WINDOW_S, lateness=f"{LATENESS_S} seconds",
                                 only_watermark=True)
             .writeStream.format("parquet").partitionBy("late").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/ck").start())
        try:
            for i in range(parts + 1):
                # A part arrives by one rename of its folder, so that a micro-batch sees all of it.
                if fs.exists(path(f"{base}/parts/part={i}")):
                    fs.rename(path(f"{base}/parts/part={i}"), path(f"{base}/in/part={i}"))
                    q.processAllAvailable()
        finally:
            q.stop()
    kind = events.schema["user_id"].dataType.simpleString()
    return spark.read.schema(f"event_id long, user_id {kind}, t_us long, allowed boolean, retry_after long, late boolean").parquet(f"{base}/out")


@register("rate_limit_stateful")
def q_rate_limit_stateful(spark, sf):
    """Every event with its decision; a late one counts as not allowed, without a time to wait."""
    return _limited(spark, sf).select("event_id", "user_id", F.coalesce("allowed", F.lit(False)).alias("allowed"),
                                      F.coalesce("retry_after", F.lit(0)).cast("long").alias("retry_after"), "late")


@register("late_event_counts")
def q_late_event_counts(spark, sf):
    """The dead letters counted by client."""
    from msgsift.streaming.limiter_state import late_counts
    return late_counts(_limited(spark, sf))


def _is_folder(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@register("validate_requests")
def q_validate_requests(spark, sf):
    from msgsift.streaming.requests import validate_requests
    docs = read_table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("request_id"), "text")
    return validate_requests(docs).select("request_id", "accepted", "reject_reason",
                                          F.length("clean_text").cast("int").alias("n_chars"))


def _bodies(spark, sf):
    """(request_id, body): every document as a JSON request, some of them wrong in one of seven ways."""
    text = F.coalesce("text", F.lit(""))
    wrong = ['{"text":', None, '{"phone": "+431"}', '{"text": 5}', '["a", "b"]', '{"text": null}', '"text"']
    kind, body = F.col("doc_id") % 12, F.to_json(F.struct(text.alias("text")))
    for k, w in enumerate(wrong):
        body = F.when(kind == k, F.lit(w) if w else F.to_json(F.struct(text.alias("text"), F.lit("+431").alias("phone")))).otherwise(body)
    return read_table(spark, sf, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("request_id"), body.alias("body"))


def _validated(df):
    from msgsift.streaming.requests import validate_json_requests
    return validate_json_requests(df).select("request_id", "accepted", "reject_reason", F.length("clean_text").cast("int").alias("n_chars"))


@register("validate_json_requests")
def q_validate_json_requests(spark, sf):
    return _validated(_bodies(spark, sf))


@register("validate_json_stream")
def q_validate_json_stream(spark, sf):
    """The same bodies as a file stream."""
    base = scratch_path(spark, "json-requests")
    _bodies(spark, sf).write.parquet(f"{base}/in")
    src = spark.readStream.schema("request_id string, body string").parquet(f"{base}/in")
    _validated(src).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _text_stream(spark, sf, table, id_col, prefix):
    """(request_id, text) of a table as a file stream."""
    schema = read_table(spark, sf, table).schema
    one = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    path = f"{sf.rstrip('/')}/{table}.parquet"
    # A stream reads folders; a table that is one file is selected by its name.
    src = one.parquet(path) if _is_folder(spark, path) else spark.readStream.schema(schema).option(
        "pathGlobFilter", f"{table}.parquet").parquet(sf)
    return src.select(F.concat(F.lit(prefix), F.col(id_col).cast("string")).alias("request_id"), "text")


@register("stream_score")
def q_stream_score(spark, sf):
    """All `benchmark` and `documents` texts arrive as file streams, are scored
    with given weights and read back from the sink; equals batch scoring."""
    from msgsift.streaming.score import read_scores, stream_score

    stream = _text_stream(spark, sf, "benchmark", "item_id", "item-").unionByName(_text_stream(spark, sf, "documents", "doc_id", "doc-"))
    base = scratch_path(spark, "score")
    q = stream_score(fixed_classifier(spark, sf), stream, f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    return round_doubles(read_scores(spark, f"{base}/out"), 9)


# -- §2.8 report-ready selections --------------------------------------------------------------


@register("top_words_chart")
def q_top_words_chart(spark, sf):
    fw = C.frequent_words(_tokens(spark, sf), top_n=20)
    return fw.select("token", "count").orderBy("count")


@register("vocabulary_chart")
def q_vocabulary_chart(spark, sf):
    sc = C.term_scores(_tokens(spark, sf))
    spam = C.typical_terms(sc, 15).select("token", F.col("log_rate_ratio_spam_vs_ham").alias("score"),
                                          F.lit("spam").alias("label"))
    ham = C.typical_terms(sc, 15, positive="ham", negative="spam").select(
        "token", F.col("log_rate_ratio_ham_vs_spam").alias("score"), F.lit("ham").alias("label"))
    return round_doubles(spam.unionByName(ham), 9)


@register("ngram_chart")
def q_ngram_chart(spark, sf):
    ng = C.frequent_ngrams(_tokens(spark, sf), sizes=(2, 3), top_n=10)
    return ng.select("ngram", "count", F.when(F.col("n") == 2, "bigram").otherwise("trigram").alias("kind"))


@register("metrics_chart")
def q_metrics_chart(spark, sf):
    runs = _runs(spark, sf)
    cmp = EV.evaluation_comparison(runs)
    long = cmp.select("evaluation_strategy", "spam_precision", "spam_recall", "spam_f1").unpivot(
        ["evaluation_strategy"], ["spam_precision", "spam_recall", "spam_f1"], "metric", "value")
    return round_doubles(long.withColumnRenamed("evaluation_strategy", "strategy"), 9)


def _points(spark, sf):
    return K.project_2d(K.with_vector(_emb(spark, sf))).withColumnRenamed("given", "cluster_id")


@register("cluster_points")
def q_cluster_points(spark, sf):
    """The facts of ``cluster_coordinates`` that SQL can state: every row is placed."""
    return _points(spark, sf).select("row_id", "cluster_id", (F.col("x").isNotNull() & F.col("y").isNotNull()).alias("placed"))


@register("cluster_coordinates")
def q_cluster_coordinates(spark, sf):
    """Every row with its plot coordinates; the largest loading of an axis is positive."""
    return _points(spark, sf).select("row_id", "cluster_id", "x", "y")


# -- §2.1 / §2.3 / §2.5 file round trips (sources, sinks, persistence) -----------------------


@register("read_messages")
def q_read_messages(spark, sf):
    """Labelled messages written as a quoted CSV with header (label,message), read back with
    default options through dialect sniffing + column resolution, in file order."""
    from msgsift.sources.delimited import read_messages, resolve_columns
    base = scratch_path(spark, "raw")
    src = labelled_raw(spark, sf).orderBy("row_id").select(F.col("label"), F.col("text").alias("message"))
    src.write.option("header", "true").option("quote", '"').option("escape", '"').csv(base)
    raw, _ = read_messages(spark, base)
    lab, txt = resolve_columns(raw)
    return Q.assign_row_id(raw, ["_order"]).select("row_id", F.col(lab).alias("label"), F.md5(txt).alias("text_md5"))


@register("validate_dataset")
def q_validate_dataset(spark, sf):
    from msgsift.sources.validate import validate_dataset
    base = scratch_path(spark, "validate")
    src = labelled_raw(spark, sf).orderBy("row_id").select(F.col("label").alias("v1"), F.col("text").alias("v2"))
    src.write.option("header", "true").option("quote", '"').option("escape", '"').csv(f"{base}/raw")
    out, _ = validate_dataset(spark, f"{base}/raw", f"{base}/validated", f"{base}/summary")
    return out.select("row_id", "label", F.md5("text").alias("text_md5"))


@register("validation_record")
def q_validation_record(spark, sf):
    """The JSON record of a validation run with duplicate removal, read back (paths left out)."""
    from msgsift.sources.validate import validate_dataset
    base = scratch_path(spark, "validate")
    src = labelled_raw(spark, sf).orderBy("row_id").select(F.col("label").alias("v1"), F.col("text").alias("v2"))
    src.write.option("header", "true").option("quote", '"').option("escape", '"').csv(f"{base}/raw")
    validate_dataset(spark, f"{base}/raw", f"{base}/validated", f"{base}/summary", drop_duplicates=True)
    rec = spark.read.json(f"{base}/summary").drop("input_file", "output_file", "summary_file")
    return rec.withColumn("detected_columns", F.array_join("detected_columns", ","))


@register("write_report_tables")
def q_write_report_tables(spark, sf):
    """All six report tables written and read back, as (table, rank, item, count)."""
    from msgsift.sources.sinks import write_report_tables
    paths = write_report_tables(C.report_tables(_tokens(spark, sf)), scratch_path(spark, "reports"))
    back = {name: spark.read.parquet(p) for name, p in paths.items()}
    item = {"frequent_words": "token", "vocabulary_by_label": "token", "spam_terms": "token", "ham_terms": "token",
            "bigrams": "ngram", "trigrams": "ngram"}
    count = {"spam_terms": "spam_count", "ham_terms": "ham_count"}
    parts = [df.select(F.lit(name).alias("table"), (F.col("rank") if "rank" in df.columns else F.lit(0)).cast("int").alias("rank"),
                       F.col(item[name]).alias("item"), F.col(count.get(name, "count")).cast("long").alias("count"))
             for name, df in back.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("confusion_rates_from_errors")
def q_confusion_rates_from_errors(spark, sf):
    """Confusion rates derived from the metric record's supports and error counts."""
    return round_doubles(EV.rates_from_errors(EV.metric_record(_pred(spark, sf), "row_stratified_split")), 9)


@register("persist_model")
def q_persist_model(spark, sf):
    """A classifier with given weights is saved, loaded (validated) and scores the test rows."""
    sp = split_messages(spark, sf, "row")
    path = scratch_path(spark, "model")
    CL.persist_model(fixed_classifier(spark, sf), path, {"split": "row"})
    return round_doubles(CL.score_messages(CL.load_model(spark, path), sp.filter(F.col("split") == "test")), 9)
