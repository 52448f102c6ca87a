"""Hard negatives by anchor-clustered shared lists (MAXIMUS-style exact inner-product search).

Components are quantised to ``floor(scale * x)``; a score is the integer inner product with the
anchor. Anchors are clustered by direction. For a cluster with centroid c, whose members lie
within angle b of c, no member u scores a candidate v above

    |u| |v| cos(max(0, angle(v, c) - b)).

Candidates are sorted by |v| cos(...) once per cluster; this list is shared by all members. A
member walks it from the top and stops as soon as its last wanted score is above the bound of
everything that follows, so its result is certified. The same walk runs twice: for the
positives (own label), then for the negatives of every positive, whose scores must lie between
``low`` and ``high`` hundredths of the positive's.

Candidates are dealt into slices of bounded size and anchors into groups of bounded size, whole
clusters together where they fit; a task holds one group and one slice with its lists. Each
slice returns at most the wanted number per anchor (and positive), and the best of these over
the slices is the result. Scores are exact: floats are used only while all products of norms
are below 2^53, else 64-bit integers.

Centroids are fitted on at most ``FIT_ANCHORS`` anchors. They set the bounds' sharpness, never
the result: angles and bounds are computed from all anchors and candidates.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no
part; of rows that share an id the one with the smallest label, then vector, takes part;
vectors of fewer components read as ending in zeros; quantised components beyond
``+-sqrt(2^62 / dimensions)`` are cut there so that scores fit 64 bits; an anchor without other
rows of its label, and a positive without a negative in its range, has no row; ties go to the
smaller id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgsift.llm._common import shared_table, small_or_shuffled

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
FIT_ANCHORS, MAX_CLUSTERS, FIT_ROUNDS = 4096, 64, 12
#: Rows of one slice and one group; a slice has at least ``LEAST_SLICE`` rows, if there are so many.
SLICE_ROWS, GROUP_ROWS, LEAST_SLICE = 1 << 17, 1 << 14, 512
#: Candidates scored at a time.
STEP = 512


def quantised(vectors: DataFrame, id_col: str, label_col: Column, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, label, q): the rows that take part, one per id."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label_col.cast("long").alias("label"), v.alias("v")).where(fine)
    edge = F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.size("v"), F.lit(1)))).cast("double")
    q = F.transform("v", lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x * F.lit(float(scale)), edge), -edge)).cast("double"), edge), -edge).cast("long"))
    rows = rows.select("vec_id", "label", q.alias("q"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")


def matrix(column, dims: int) -> np.ndarray:
    """An Arrow list column as an (n, dims) integer matrix, shorter rows filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit rows, norms); a zero row keeps direction zero."""
    x = rows.astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norms > 0, norms, 1.0)[:, None], norms


def angles(units: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centroids.T, -1.0, 1.0))


def fit_centroids(anchors: np.ndarray, clusters: int, rounds: int = FIT_ROUNDS, seed: int = 42) -> np.ndarray:
    """Unit centroids of the anchors' directions (spherical k-means)."""
    units, norms = directions(anchors)
    units = units[norms > 0]
    if not len(units):
        return np.eye(1, max(anchors.shape[1], 1))
    centroids = units[np.random.default_rng(seed).permutation(len(units))[:clusters]]
    for _ in range(rounds):
        near = (units @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, units)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 0, sums / np.where(length > 0, length, 1.0), centroids)
    return centroids


def clustered(anchors: DataFrame, n_anchors: int, dims: int) -> tuple[DataFrame, np.ndarray, dict[int, float], dict[int, int]]:
    """(anchors with ``cluster`` and ``angle``, centroids, widest angle and size per cluster)."""
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ANCHORS).select("q").toArrow().column(0)
    centroids = fit_centroids(matrix(sample, dims), min(MAX_CLUSTERS, max(1, math.isqrt(n_anchors) // 2)))

    def place(rows: pd.Series) -> pd.DataFrame:
        units, _ = directions(matrix(pa.array(rows, pa.list_(pa.int64())), dims))
        a = angles(units, centroids)
        best = a.argmin(axis=1)
        return pd.DataFrame({"cluster": best.astype(np.int32), "angle": a[np.arange(len(a)), best]})

    placed = anchors.withColumn("p", F.pandas_udf(place, "cluster int, angle double")("q"))
    placed = shared_table(placed.select("vec_id", "label", "q", "p.cluster", "p.angle"), "neg-anchors")
    facts = placed.groupBy("cluster").agg(F.max("angle").alias("a"), F.count(F.lit(1)).alias("n")).collect()  # one row per cluster
    return placed, centroids, {r.cluster: r.a for r in facts}, {r.cluster: r.n for r in facts}


def groups_of(sizes: dict[int, int], room: int = GROUP_ROWS) -> tuple[dict[int, tuple[int, int]], int]:
    """cluster -> (first group, number of groups): clusters share a group while they fit, and a
    larger one is spread over several."""
    where, group, used = {}, 0, 0
    for cluster, n in sorted(sizes.items()):
        parts = -(-n // room)
        if used and used + n > room:
            group, used = group + 1, 0
        where[cluster] = (group, parts)
        if parts > 1:
            group, used = group + parts, 0
        else:
            used += n
    return where, group + (1 if used else 0)


class Slice:
    """Candidates of one slice with the shared list of each cluster."""

    def __init__(self, table: pa.Table, dims: int):
        self.ids = np.asarray(table["vec_id"].combine_chunks(), np.int64)
        self.labels = np.asarray(table["label"].combine_chunks(), np.int64)
        self.q = matrix(table["q"], dims)
        self.units, self.norms = directions(self.q)

    def list_of(self, centroid: np.ndarray, widest: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, bounds for a member of norm 1), highest bound first."""
        # The arc cosine is good to about 1e-8; the margin keeps every bound an upper one.
        apart = np.maximum(angles(self.units, centroid[None, :])[:, 0] - widest - 1e-6, 0.0)
        bounds = self.norms * np.cos(np.minimum(apart, np.pi))
        order = np.argsort(-bounds, kind="stable")
        return order, bounds[order] + self.norms[order] * 1e-9


def walk(part: Slice, order: np.ndarray, bounds: np.ndarray, q: np.ndarray, norms: np.ndarray, same: bool, ids: np.ndarray,
         labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """Per row of ``q`` the first ``k`` (-score, id) with low <= score <= high, of the own label (not
    the row itself) or of the others. Rows leave as soon as the list cannot change their result."""
    exact = np.float64 if (norms.max(initial=0) + 1) * (part.norms.max(initial=0) + 1) < 2**52 else np.int64
    found: list[list[tuple[int, int]]] = [[] for _ in ids]
    least = low.copy()  # a score below this cannot enter any more
    active = np.arange(len(ids))
    for start in range(0, len(order), STEP):
        # Scores are integers: half a unit more than the float bound is still an upper bound.
        active = active[bounds[start] * norms[active] * (1 + 1e-9) + 0.5 >= least[active]]
        if not len(active):
            break
        rows = order[start:start + STEP]
        scores = (q[active].astype(exact) @ part.q[rows].astype(exact).T).astype(np.int64)
        own = part.labels[rows][None, :] == labels[active][:, None]
        fits = (own if same else ~own) & (part.ids[rows][None, :] != ids[active][:, None])
        fits &= (scores >= least[active][:, None]) & (scores <= high[active][:, None])
        for a in np.flatnonzero(fits.any(axis=1)).tolist():
            cols, i = np.flatnonzero(fits[a]), active[a]
            new = sorted([*found[i], *zip((-scores[a, cols]).tolist(), part.ids[rows[cols]].tolist(), strict=True)])[:k]
            found[i] = new
            if len(new) == k:
                least[i] = max(least[i], -new[-1][0])
    return found


def _searched(anchors: DataFrame, candidates: DataFrame, n_rows: int, dims: int, centroids: np.ndarray, widest: dict[int, float],
              sizes: dict[int, int], same: bool, k: int) -> DataFrame:
    """(anchor_id, positive_id, score, vec_id): up to ``k`` per slice of the wanted rows of each anchor.

    ``anchors`` carries ``wants``: one (positive_id, low, high) for each search of the row.
    """
    spark = anchors.sparkSession
    where, n_groups = groups_of(sizes)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(-(-n_rows // SLICE_ROWS), min(least, -(-n_rows // LEAST_SLICE)), 1)
    first = F.create_map(*[F.lit(x) for c, (g, _) in where.items() for x in (c, g)])
    parts = F.create_map(*[F.lit(x) for c, (_, p) in where.items() for x in (c, p)])
    group = first[F.col("cluster")] + F.pmod(F.xxhash64("vec_id"), parts[F.col("cluster")])
    left = anchors.withColumn("g", group.cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    right = candidates.withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int")).withColumn(
        "g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if mine.num_rows and theirs.num_rows:
            part = Slice(theirs, dims)
            clusters = np.asarray(mine["cluster"].combine_chunks())
            for c in np.unique(clusters).tolist():
                members = mine.filter(pa.array(clusters == c))
                wants = members["wants"].combine_chunks()
                at = np.repeat(np.arange(len(members)), np.diff(np.asarray(wants.offsets)))
                flat = wants.flatten()
                q = matrix(members["q"], dims)[at]
                ids = np.asarray(members["vec_id"].combine_chunks(), np.int64)[at]
                labels = np.asarray(members["label"].combine_chunks(), np.int64)[at]
                order, bounds = part.list_of(centroids[c], widest[c])
                got = walk(part, order, bounds, q, directions(q)[1], same, ids, labels,
                           np.asarray(flat.field("low"), np.int64), np.asarray(flat.field("high"), np.int64), k)
                for a, p, found in zip(ids.tolist(), flat.field("positive_id").to_pylist(), got, strict=True):
                    for minus, v in found:
                        out[0].append(a)
                        out[1].append(p)
                        out[2].append(-minus)
                        out[3].append(v)
        return pa.table([pa.array(x, pa.int64()) for x in out], ["anchor_id", "positive_id", "score", "vec_id"])

    return left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(
        search, "anchor_id long, positive_id long, score long, vec_id long")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id``; ``label`` is an expression over ``vectors``.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    clean = shared_table(quantised(vectors, id_col, label, vector_col, scale), "neg-rows")
    n_rows, n_anchors, dims = clean.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1)), F.max(F.size("q"))).first()
    if not n_anchors:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = max(dims, 1)
    anchors, centroids, widest, sizes = clustered(clean.where(is_anchor), n_anchors, dims)
    ends = (F.lit(-(2**63)).cast("long"), F.lit(2**63 - 1).cast("long"))

    def first_of(found: DataFrame, k: int) -> DataFrame:
        """The best ``k`` of each anchor and positive; a group has at most ``k`` rows per slice."""
        by = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    any_score = F.array(F.struct(F.lit(0).cast("long").alias("positive_id"), ends[0].alias("low"), ends[1].alias("high")))
    near = _searched(anchors.withColumn("wants", any_score), clean, n_rows, dims, centroids, widest, sizes, True, positives)
    near = shared_table(first_of(near, positives), "neg-positives")
    # low * positive <= 100 * negative <= high * positive, for whole numbers.
    score = F.col("score").cast("decimal(38,0)")
    bounds = F.struct(F.col("vec_id").alias("positive_id"), F.ceil(score * low / 100).cast("long").alias("low"),
                      F.floor(score * high / 100).cast("long").alias("high"))
    wants = near.groupBy(F.col("anchor_id").alias("wa")).agg(F.collect_list(bounds).alias("wants"))
    wants = shared_table(wants, "neg-wants")
    searching = anchors.join(small_or_shuffled(wants, n_anchors), F.col("vec_id") == F.col("wa")).drop("wa")
    far = _searched(searching, clean, n_rows, dims, centroids, widest, sizes, False, negatives)
    far = shared_table(first_of(far, negatives), "neg-found")
    scores = near.select(F.col("anchor_id").alias("pa"), F.col("vec_id").alias("pp"), F.col("score").alias("positive_score"))
    out = far.join(scores, (F.col("anchor_id") == F.col("pa")) & (F.col("positive_id") == F.col("pp")))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))
