"""Clustering of embedded messages and cluster reports.

Vectors stay a distributed column; the cosine silhouette (closed form, O(n*k*d), never
pairwise) and PCA are Spark ML jobs over the cached vectors, KMeans runs all its models in the
same passes (``kmeans.py``). Only centres and a d x 2 projection reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgsift.operators.kmeans import Clustering, fit_all

# Theme rules (spam-rate cut-off, sample size, keyword sets in priority order).
THEME_SPAM_RATE = 0.65
THEME_SAMPLE = 20
SPAM_THEMES = (
    (("free", "claim", "prize", "win", "won"), "promotional prize or claim spam"),
    (("txt", "text", "stop", "reply"), "text/reply campaign spam"),
)
SPAM_FALLBACK = "spam-heavy promotional messages"
HAM_THEMES = (
    (("call", "later", "home", "going", "come"), "personal coordination messages"),
    (("love", "dear", "happy", "sorry"), "personal relationship messages"),
)
HAM_FALLBACK = "mixed conversational messages"


class ClusteringError(ValueError):
    """Raised when clustering cannot run."""


def with_vector(df: DataFrame, array_col: str = "embedding", out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array_col)))


def kmeans_fit(df: DataFrame, k: int, *, seed: int = 42, n_init: int = 20, features: str = "features",
               max_iter: int = 300) -> Clustering:
    """Best (lowest cost) of ``n_init`` restarts, each run until its centres stop moving or
    ``max_iter``; all restarts share their passes."""
    if k < 2:
        raise ClusteringError(f"{k} clusters asked for; 2 is the least")
    return fit_all(df, [k], n_init=n_init, seed=seed, features=features, max_iter=max_iter)[k]


def _vector_sums(df: DataFrame, group_col: str, array_col: str) -> DataFrame:
    """(c, s, n) per group: element-wise sum and count, one vector per group and task in the shuffle."""
    vec = df.select(F.col(group_col).cast("int").alias("c"), array_to_vector(F.transform(array_col, lambda x: x.cast("double"))).alias("v"))
    return vec.groupBy("c").agg(Summarizer.sum(F.col("v")).alias("s"), F.count(F.lit(1)).alias("n")).select(
        "c", vector_to_array("s").alias("s"), "n")


def label_centroids(df: DataFrame, group_col: str, *, array_col: str = "embedding") -> DataFrame:
    """(c, centroid): mean vector per group, a table with one row per group."""
    sums = _vector_sums(df, group_col, array_col).withColumn("_n", F.col("n").cast("double"))
    return sums.select("c", F.transform("s", lambda x: x / F.col("_n")).alias("centroid"))


def _gathered(rows: DataFrame, out: str) -> DataFrame:
    """All rows of a k-row table as one array, sorted by its first column, for a scalar subquery."""
    return rows.agg(F.sort_array(F.collect_list(F.struct(*rows.columns))).alias(out))


def nearest_centroid(df: DataFrame, centroids: DataFrame, *, array_col: str = "embedding") -> DataFrame:
    """Add cluster_id (the rank of the centroid's ``c``) and Euclidean distance_to_centroid.

    The k centroids are one scalar subquery; distances are higher-order functions in the JVM."""
    one = _gathered(centroids, "_cents")
    e = F.col(array_col)
    joined = df.withColumn("_cents", one.scalar())
    dists = F.transform(
        "_cents",
        lambda c, i: F.struct(
            F.sqrt(F.aggregate(F.zip_with(e, c["centroid"], lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)),
                               F.lit(0.0), lambda acc, x: acc + x)).alias("d"),
            i.alias("i"),
        ),
    )
    best = joined.withColumn("_best", F.array_min(dists))
    return best.withColumn("cluster_id", F.col("_best.i").cast("int")).withColumn(
        "distance_to_centroid", F.col("_best.d")).drop("_best", "_cents")


def silhouette(df: DataFrame, *, prediction: str = "cluster_id", features: str = "features",
               distance: str = "cosine") -> float:
    """Mean silhouette (cosine by default) via Spark's closed-form evaluator."""
    ev = ClusteringEvaluator(predictionCol=prediction, featuresCol=features, distanceMeasure=distance,
                             metricName="silhouette")
    return float(ev.evaluate(df.withColumn(prediction, F.col(prediction).cast("double"))))


def silhouette_table(df: DataFrame, *, prediction: str = "cluster_id", array_col: str = "embedding") -> DataFrame:
    """Mean cosine silhouette as a one-row DataFrame, closed form in O(n*k*d).

    Per cluster C the sum S_C of unit vectors and the size |C| (k x d, collected:
    bounded by k). For a unit vector x in cluster A: mean distance to another
    cluster C is 1 - x.S_C/|C|; to its own cluster (itself excluded)
    1 - (x.S_A - 1)/(|A| - 1); singletons score 0."""
    from msgsift.operators.features import with_l2_normalized

    unit = with_l2_normalized(df.select(F.col(prediction).cast("int").alias("_c"), F.col(array_col).alias("_v")), "_v")
    one = _gathered(_vector_sums(unit, "_c", "_v"), "_cl")
    v = F.col("_v")
    dot = lambda s: F.aggregate(F.zip_with(v, s, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    scored = unit.withColumn("_cl", one.scalar()).withColumn("_dots", F.transform("_cl", lambda x: F.struct(
        (x["c"] == F.col("_c")).alias("own"), dot(x["s"]).alias("d"), x["n"].cast("double").alias("n"))))
    per = F.transform("_dots", lambda x: F.struct(
        x["own"].alias("own"),
        F.when(x["own"], F.when(x["n"] > 1, 1 - (x["d"] - 1) / (x["n"] - 1)).otherwise(F.lit(0.0))).otherwise(1 - x["d"] / x["n"]).alias("dist"),
        x["n"].alias("n")))
    scored = scored.withColumn("_per", per)
    own = F.filter(F.col("_per"), lambda x: x["own"])[0]
    b = F.array_min(F.transform(F.filter(F.col("_per"), lambda x: ~x["own"]), lambda x: x["dist"]))
    a = own["dist"]
    sil = F.when((own["n"] <= 1) | b.isNull(), F.lit(0.0)).otherwise(
        F.when(F.greatest(a, b) == 0, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b)))
    return scored.select(sil.alias("s")).agg(F.avg("s").alias("silhouette"))


def select_k_table(df: DataFrame, clusters: str | int = "auto", *, seed: int = 42, features: str = "features",
                   n_init: int = 10) -> DataFrame:
    """(k, silhouette, best) for each cluster count tried: 3..min(8, n-1) for "auto", else the given
    one (2 <= k < n). The best has the highest cosine silhouette, the smallest k on ties. At most
    six rows; all fits share their passes."""
    n = df.count()
    if clusters == "auto":
        if n < 4:
            raise ClusteringError(f"{n} messages are too few to choose a cluster count; 4 are needed")
        tried = range(3, min(8, n - 1) + 1)
    else:
        tried = [int(clusters)]
        if not 2 <= tried[0] < n:
            raise ClusteringError(f"{tried[0]} clusters do not fit {n} messages; it takes 2 to {n - 1}")
    data = df.select(features).cache()
    models = fit_all(data, list(tried), n_init=n_init, seed=seed, features=features)
    scores = [(k, silhouette(models[k].transform(data, "cluster_id"), features=features)) for k in tried]
    data.unpersist()
    best = max(scores, key=lambda x: (x[1], -x[0]))[0]
    return df.sparkSession.createDataFrame([(k, s, k == best) for k, s in scores], "k int, silhouette double, best boolean")


def select_k(df: DataFrame, clusters: str | int = "auto", *, seed: int = 42, features: str = "features",
             n_init: int = 10) -> tuple[int, float]:
    """The chosen cluster count and its silhouette."""
    row = select_k_table(df, clusters, seed=seed, features=features, n_init=n_init).filter("best").first()
    return row["k"], row["silhouette"]


def project_2d(df: DataFrame, *, features: str = "features") -> DataFrame:
    """Centred PCA to two coordinates x, y (2-D input passes through unchanged). The sign of an axis is
    fixed: its loading of the largest absolute value, the first on ties, is positive."""
    first = df.select(features).first()
    if first is not None and first[0].size == 2:
        arr = vector_to_array(F.col(features))
        return df.withColumn("x", arr[0]).withColumn("y", arr[1])
    centred = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False).fit(df).transform(df)
    pca = PCA(k=2, inputCol="_centred", outputCol="_pc").fit(centred)
    out = pca.transform(centred)
    arr = vector_to_array(F.col("_pc"))
    axes = pca.pc.toArray()
    sign = [1.0 if a[np.argmax(np.abs(a) > np.abs(a).max() * (1 - 1e-9))] > 0 else -1.0 for a in axes.T]
    return out.withColumn("x", arr[0] * F.lit(sign[0])).withColumn("y", arr[1] * F.lit(sign[1])).drop("_centred", "_pc")


def cluster_assignments(df: DataFrame, cols: Sequence[str] = ("row_id", "label", "text", "cluster_id",
                                                              "distance_to_centroid", "x", "y")) -> DataFrame:
    """Per-row outputs side by side, ordered by cluster, distance, row_id."""
    present = [c for c in cols if c in df.columns]
    return df.select(*present).orderBy("cluster_id", "distance_to_centroid", "row_id")


def cluster_overview(assign: DataFrame, *, positive: str = "spam", negative: str = "ham") -> DataFrame:
    """Per cluster: size, negative/positive counts and positive rate."""
    return assign.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if(F.col("label") == negative).alias(negative),
        F.count_if(F.col("label") == positive).alias(positive),
        F.avg((F.col("label") == positive).cast("double")).alias(f"{positive}_rate"),
    )


def _nearest(assign: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("cluster_id").orderBy("distance_to_centroid", "row_id")
    return assign.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def cluster_representatives(assign: DataFrame, n: int = 5) -> DataFrame:
    """n nearest rows per cluster (ties by row_id); '|' in text replaced by '/'."""
    return _nearest(assign, n).select("cluster_id", "rank", "row_id", "label",
                                      F.replace(F.col("text"), F.lit("|"), F.lit("/")).alias("text"))


def cluster_theme(assign: DataFrame, *, positive: str = "spam", sample: int = THEME_SAMPLE) -> DataFrame:
    """Rule-based theme from the positive rate and keyword *substrings* in the
    ``sample`` nearest texts (lower-cased), in priority order."""
    rate = assign.groupBy("cluster_id").agg(F.avg((F.col("label") == positive).cast("double")).alias("_rate"))
    near = _nearest(assign, sample).withColumn("_t", F.lower(F.col("text")))

    def has(words: Sequence[str]) -> Column:
        return F.max(F.greatest(*[F.col("_t").contains(w).cast("int") for w in words]))

    flags = near.groupBy("cluster_id").agg(
        *[has(w).alias(f"_s{i}") for i, (w, _) in enumerate(SPAM_THEMES)],
        *[has(w).alias(f"_h{i}") for i, (w, _) in enumerate(HAM_THEMES)],
    )
    spam_rule = F.when(F.col("_s0") == 1, SPAM_THEMES[0][1]).when(F.col("_s1") == 1, SPAM_THEMES[1][1]).otherwise(
        SPAM_FALLBACK)
    ham_rule = F.when(F.col("_h0") == 1, HAM_THEMES[0][1]).when(F.col("_h1") == 1, HAM_THEMES[1][1]).otherwise(
        HAM_FALLBACK)
    return rate.join(flags, "cluster_id").select(
        "cluster_id", F.when(F.col("_rate") >= THEME_SPAM_RATE, spam_rule).otherwise(ham_rule).alias("theme"))


# The part a provider plays in a comparison.
PROVIDER_ROLES = {"given-labels": "reference grouping", "lsa-local": "local reproducible path", "remote-embeddings": "remote embedding path"}


def cluster_metadata(df: DataFrame, *, provider: str, model: str, prediction: str = "cluster_id", array_col: str = "embedding",
                     notes: str = "", seed: int = 42, paths: dict[str, str] | None = None) -> DataFrame:
    """One-row run record over the clustered vectors: provider, model, measured dimensions, notes,
    role, algorithm, cluster and message counts, silhouette, seed, and where inputs and outputs lie
    (dataset, assignments, summary, embeddings, metadata). Partition by provider when written."""
    paths = paths or {}
    facts = df.agg(F.max(F.size(array_col)).alias("embedding_dimensions"), F.count_distinct(prediction).cast("int").alias("cluster_count"),
                   F.count(F.lit(1)).cast("int").alias("total_messages"))
    score = silhouette_table(df, prediction=prediction, array_col=array_col).scalar()
    return facts.select(
        *[F.lit(paths.get(k, "")).alias(k) for k in ("dataset", "assignments_output", "summary_output", "embeddings_output", "metadata_output")],
        F.lit(provider).alias("embedding_provider"), F.lit(model).alias("embedding_model"), "embedding_dimensions",
        F.lit(notes).alias("embedding_notes"), F.lit(PROVIDER_ROLES.get(provider, "other")).alias("embedding_provider_role"),
        F.lit("KMeans").alias("clustering_algorithm"), "cluster_count", "total_messages", score.alias("silhouette_score"),
        F.lit(int(seed)).alias("random_state"))


def provider_comparison(metadata: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected provider ("not generated" when missing) and the best
    provider by silhouette (null counts as -inf)."""
    names = F.explode(F.array(*[F.lit(p) for p in expected])).alias("embedding_provider")
    exp = metadata.sparkSession.range(1).select(names)
    known = metadata.select("embedding_provider", "embedding_model", "embedding_dimensions", "total_messages", "cluster_count", "silhouette_score")
    joined = exp.join(known, "embedding_provider", "left").withColumn(
        "status", F.when(F.col("cluster_count").isNull(), "not generated").otherwise("generated"))
    best = joined.agg(F.max_by("embedding_provider", F.coalesce(F.col("silhouette_score"),
                                                                F.lit(float("-inf")))).alias("best")).scalar()
    role = F.coalesce(*[F.when(F.col("embedding_provider") == k, F.lit(v)) for k, v in PROVIDER_ROLES.items()], F.lit("other"))
    return joined.withColumn("role", role).withColumn("is_best", F.col("embedding_provider") == best)
