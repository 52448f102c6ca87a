"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, space-joined shingles of
``shingle`` words with repeats (fewer words: the whole sequence), XXH64 with seed 42 of each;
a bit is 1 where more than half of the hashes have it. No words: fingerprint zero, linked like
any other.

Candidates: for radius r each bit position gets a non-zero vector of r + 1 bits, and each of
the 2^(r+1) - 1 non-zero vectors v is a mask of the positions with odd inner product. Any r
positions span at most r dimensions, so some v is orthogonal to all of them: the two
fingerprints agree on that mask and meet in its table. No pair within the radius is missed.

Distinct fingerprints enter the tables, so copies collapse first. Keys that occur once are
dropped by a counted aggregation. A bucket is linked on its own, never as all its pairs:

* up to ``bucket_limit`` fingerprints: a search over the bucket's array reports one link per
  fingerprint to the first of its cluster, after checking every bit distance;
* beyond that: each fingerprint is expanded to all points within r/2 flips of the bits that the
  mask leaves free. Two fingerprints of the bucket are within r exactly when they share such a
  point, so every group that meets at a point is linked to one of its members. The rows are
  spread over the points, and a point has a bounded number of members.

Links become components by star rounds on shared files. Defined results: null and empty texts
have fingerprint zero; null ids never become a component id unless all are null; repeated rows
belong to the same component; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgsift.llm._common import fresh, null_safe, shared_table, small_or_shuffled
from msgsift.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET_LIMIT = 4096
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned 64-bit integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
        starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)], "<u8")
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 512:
        counts = np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(lanes[:, j], minlength=256) @ _BITS for j in range(8)])
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    """Pandas UDF text -> fingerprint as a signed long (Arrow batches, one text at a time)."""

    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(prints, "long")


def masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 covering masks over 64 bits."""
    dims = (1 << (radius + 1)) - 1
    vector = [1 + i % dims for i in range(64)]
    return [sum(1 << i for i in range(64) if (vector[i] & v).bit_count() & 1) for v in range(1, dims + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cluster(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, first) links of the clusters of distinct fingerprints; O(n) memory."""
    left = np.sort(prints.astype(np.int64)).view(np.uint64)
    links = []
    while len(left) > 1:
        root, queue, left = int(left[:1].view(np.int64)[0]), [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found = left[near]
                links.extend((member, root) for member in found.view(np.int64).tolist())
                queue.extend(found)
                left = left[~near]
    return links


def _links_of_buckets(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for prints in batch.column(0):
                for a, b in cluster(np.array(prints.values, np.int64), radius):
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _expand_free(radius: int):
    """(mid, print, near): points within half the radius over the free bits of the mask.

    An odd radius needs half + 1 flips on one side; only points within half (near) may stand
    for a group, so that members of the far side are not linked to each other directly.
    """
    table = masks(radius)
    half, far = radius // 2, radius - radius // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t not in flips:
                    free = [i for i in range(64) if not table[t] >> i & 1]
                    sets = [c for k in range(far + 1) for c in combinations(free, k)]
                    flips[t] = (np.array([sum(1 << i for i in c) for c in sets], np.uint64),
                                np.array([len(c) <= half for c in sets]))
                bits, near = flips[t]
                mids = (bits ^ np.uint64(x & 0xFFFFFFFFFFFFFFFF)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mids), pa.array(np.full(len(mids), x, np.int64)), pa.array(near)], ["mid", "fp", "near"])

    return run


def link(prints: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp``; their components are those of all pairs
    within ``radius``."""
    keys = F.array(*[F.struct(F.lit(t).cast("int").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for t, m in enumerate(masks(radius))])
    rows = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    counts = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    counts = shared_table(counts.select(F.col("t").alias("bt"), F.col("key").alias("bk"), "n"), "sim-buckets")
    met = rows.join(small_or_shuffled(counts), (F.col("t") == F.col("bt")) & (F.col("key") == F.col("bk")))
    met = shared_table(met.select("t", "key", "fp", "n"), "sim-met")
    usual = met.where(F.col("n") <= bucket_limit).groupBy("t", "key").agg(F.collect_set("fp").alias("fps"))
    links = usual.select("fps").mapInArrow(_links_of_buckets(radius), "u long, v long")
    large = met.where(F.col("n") > bucket_limit)
    if counts.where(F.col("n") > bucket_limit).count():
        points = large.select("t", "fp").mapInArrow(_expand_free(radius), "mid long, fp long, near boolean")
        grouped = points.groupBy("mid").agg(
            F.min(F.when(F.col("near"), F.col("fp"))).alias("v"), F.collect_set("fp").alias("us"))
        links = links.unionByName(grouped.where(F.col("v").isNotNull() & (F.size("us") > 1)).select(
            F.explode("us").alias("u"), "v"))
    return links


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(doc_id, sig, fp, root, component_id) per row; ``fp`` is a signed long, ``root`` the
    fingerprint that names the component (ids may be null), ``sig`` a hash of the text."""
    prints = shared_table(df.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("sig"),
                                    fingerprint_udf(shingle)(F.col(text_col)).alias("fp")), "sim-prints")
    distinct = shared_table(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("rows")), "sim-distinct")
    roots = components(link(distinct.select("fp"), radius, bucket_limit))
    tree = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", "rows", F.coalesce("root", "fp").alias("root"))
    lows = tree.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component"), F.sum("rows").alias("members"))
    # Only groups of several rows need a lookup: a row of its own is its component.
    map_ = tree.join(lows.where(F.col("members") > 1), F.col("root") == F.col("r")).select(
        F.col("fp").alias("mfp"), F.col("root").alias("mroot"), "component")
    map_ = shared_table(map_, "sim-map")
    out = prints.join(small_or_shuffled(map_), F.col("fp") == F.col("mfp"), "left")
    return out.select("doc_id", "sig", "fp", F.coalesce("mroot", "fp").alias("root"),
                      F.when(F.col("mfp").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
           radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per row: doc_id, fingerprint (16 lower-case hex digits), component_id."""
    out = near_duplicates(df, id_col, text_col, shingle, radius, bucket_limit)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """The columns of ``df``, one row of each group: the smallest id, nulls last, then the
    smallest text hash. Of repeated rows with that id and text one stays. Fingerprints are
    computed once; rows are found again by id and text hash."""
    groups = shared_table(near_duplicates(df, id_col, text_col, shingle, radius, bucket_limit), "sim-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "sig")
    first = groups.groupBy("root").agg(F.min(rank).alias("k")).select("root", "k.doc_id", "k.sig")
    repeated = groups.groupBy("root", "doc_id", "sig").agg(F.count(F.lit(1)).alias("rows"))
    winners = first.join(repeated.toDF("rr", "rd", "rs", "rows"), (F.col("root") == F.col("rr"))
                         & F.col("doc_id").eqNullSafe(F.col("rd")) & (F.col("sig") == F.col("rs")))
    names = [fresh(df, s) for s in ("sim_doc", "sim_sig", "sim_rows")]
    winners = shared_table(winners.select("doc_id", "sig", "rows"), "sim-winners").toDF(*names)
    own = fresh(df, "sim_own")
    marked = df.withColumn(own, F.xxhash64(F.col(text_col)))
    once = winners.where(F.col(names[2]) == 1)
    kept = marked.join(small_or_shuffled(once), null_safe(marked, once, [(id_col, names[0]), (own, names[1])]), "left_semi")
    many = winners.where(F.col(names[2]) > 1)
    if many.count():
        twins = marked.join(small_or_shuffled(many), null_safe(marked, many, [(id_col, names[0]), (own, names[1])]), "left_semi")
        kept = kept.unionByName(twins.dropDuplicates([id_col, own]))
    return kept.select(*df.columns)
