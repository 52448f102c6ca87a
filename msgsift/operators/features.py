"""TF-IDF features, sparse assembly, LSA embeddings, L2 normalisation, batched
external embeddings.

TF-IDF is computed in long form ``(row_id, idx, term, weight)``:

* term frequencies are counts by (row, term),
* the vocabulary is ``groupBy(term)`` with partial aggregation (document
  frequency, total term frequency), filtered by ``min_df`` and optionally cut to the
  ``max_features`` most frequent terms (a bounded table, then broadcast),
* weights: sublinear tf ``1 + ln(tf)``, smooth idf ``ln((1 + n) / (1 + df)) + 1``,
  L2-normalised per row - the row norm is taken over the row's own entries after
  one shuffle by ``row_id`` (a group bounded by the length of one message).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, LongType, StructField, StructType

from msgsift.functions.text import counted_in_row, ngram_range_terms, stopword_filter, word_analyzer
from msgsift.operators.quality import assign_row_id
from msgsift.operators.row_blocks import Block, pack_rows, partitions, summed
from msgsift.operators.term_table import Piece, meet, term_stats
from msgsift.session import cut_lineage, on_files, scratch_path, shuffles_freed


class EmbeddingError(ValueError):
    """Raised when embeddings cannot be built."""


def with_terms(df: DataFrame, *, text_col: str = "text", out: str = "terms", max_n: int = 2,
               stopwords: Iterable[str] | None = None) -> DataFrame:
    """Feature terms: analyzer tokens (lower, accents stripped, Unicode words) plus
    2..max_n-grams (stopwords, if given, removed before building n-grams)."""
    tmp = f"_{out}_tok"
    df = df.withColumn(tmp, word_analyzer(F.col(text_col)))
    if stopwords is not None:
        # materialise the filtered array: n-gram lambdas must reference a column
        df = df.withColumn(tmp, stopword_filter(F.col(tmp), stopwords))
    return df.withColumn(out, ngram_range_terms(F.col(tmp), max_n=max_n)).drop(tmp)


def build_vocabulary(df: DataFrame, *, terms_col: str = "terms", min_df: int = 2,
                     max_features: int | None = None) -> DataFrame:
    """(idx, term, df, tf_total, idf, n_docs): terms with document frequency >= min_df,
    optionally the max_features with the largest total term frequency (ties by term);
    indices follow term order. idf = ln((1+n)/(1+df)) + 1."""
    n_docs = df.select(F.count(F.lit(1))).scalar()
    stats = term_stats(df, terms_col, min_df)
    if max_features is not None:
        stats = stats.orderBy(F.desc("tf_total"), F.asc("term")).limit(max_features)
        vocab = stats.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    else:
        # unbounded vocabulary: dense index without a one-partition window
        vocab = assign_row_id(stats, ["term"], out="idx").withColumn("idx", (F.col("idx") - 1).cast("int"))
    return vocab.withColumn("n_docs", n_docs.cast("long")).withColumn(
        "idf", F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    ).select("idx", "term", "df", "tf_total", "idf", "n_docs")


def tfidf_transform(df: DataFrame, vocab: DataFrame, *, terms_col: str = "terms",
                    broadcast_vocab: bool = False, term: bool = True) -> DataFrame:
    """Long-form L2-normalised TF-IDF (row_id, idx, term, weight) of ``df`` under a
    fitted vocabulary, without the strings unless ``term``. Unknown terms are dropped; rows without a known term keep one
    row with null idx/weight so zero vectors survive (use ``to_sparse_rows``).

    The rows meet the vocabulary in packed pieces (``term_table.py``). The counts of rows that share an id
    are added; such rows, and a vocabulary small enough for a broadcast, are joined term by term."""
    columns = ["row_id", "idx", *["term"] * term, "weight"]
    if broadcast_vocab:
        return _tfidf_by_window(df, F.broadcast(vocab), terms_col).select(*columns)
    once, again = by_repeated_id(df)

    def finish(p: Piece) -> pa.RecordBatch:
        idx, idf = p.values
        row, place, tf = p.entries()
        w = (1 + np.log(tf)) * idf[place]
        weight = w / np.sqrt(np.bincount(row, w * w, minlength=len(p.ids)))[row]
        none = np.setdiff1d(np.arange(len(p.ids)), row)
        absent = len(none)
        out = [p.ids.take(pa.array(np.r_[row, none])), pa.concat_arrays([pa.array(idx[place].astype(np.int32)), pa.nulls(absent, pa.int32())])]
        if term:
            out.append(pa.concat_arrays([p.terms.take(pa.array(place)), pa.nulls(absent, pa.string())]))
        return pa.RecordBatch.from_arrays([*out, pa.concat_arrays([pa.array(weight), pa.nulls(absent, pa.float64())])], columns)

    kind = df.schema["row_id"].dataType.simpleString()
    long = meet(once, vocab, ["idx", "idf"], finish, f"row_id {kind}, idx int, {'term string, ' * term}weight double", terms_col=terms_col, terms=term)
    return long if again is None else long.unionByName(_tfidf_by_window(again, vocab, terms_col).select(*columns))


def by_repeated_id(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(the rows whose id no other row has, those with a repeated id or None if there are none)."""
    ids = cut_lineage(df.groupBy("row_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("row_id").alias("_id")))
    if ids.isEmpty():
        return df, None
    same = F.col("row_id").eqNullSafe(F.col("_id"))
    return df.join(ids, same, "left_anti"), df.join(ids, same, "left_semi")


def _tfidf_by_window(df: DataFrame, vocab: DataFrame, terms_col: str) -> DataFrame:
    """``tfidf_transform`` for any ids: the norm is a window over the row's own entries."""
    v = vocab.select(F.col("term").alias("_vt"), "idx", "idf")
    tf = counted_in_row(df, terms_col)
    known = tf.join(v, F.col("term") == F.col("_vt")).select("row_id", "idx", F.col("_vt").alias("term"), "tf", "idf")
    none = df.select("row_id", *[F.lit(None).cast(known.schema[c].dataType).alias(c) for c in ("idx", "term", "tf", "idf")])
    entry = Window.partitionBy("row_id", "idx")
    w = known.unionByName(none).withColumn("_n", F.sum("tf").over(entry)).withColumn("_rk", F.row_number().over(entry.orderBy("idx")))
    w = w.where("_rk = 1").select("row_id", "idx", "term", ((1 + F.log("_n")) * F.col("idf")).alias("w"))
    w = w.withColumn("_norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("row_id"))))
    return w.filter(F.col("idx").isNotNull() | F.col("_norm").isNull()).select(
        "row_id", "idx", "term", (F.col("w") / F.col("_norm")).alias("weight"))


def to_sparse_rows(long_df: DataFrame, size: int | Column) -> DataFrame:
    """(row_id, size, indices, values) with indices ascending; one row per row_id.

    The entries of a row that lie together in a partition (``tfidf_transform`` leaves all of them so) are
    shuffled as one pair of plain arrays."""
    e = F.col("idx").isNotNull()
    g = long_df.groupBy("row_id").agg(F.collect_list(F.when(e, F.col("idx"))).alias("_i"), F.collect_list(F.when(e, F.col("weight"))).alias("_w"))
    g = g.select("row_id", F.sort_array(F.arrays_zip("_i", "_w")).alias("_e"))
    return g.select(
        "row_id",
        (F.lit(size) if isinstance(size, int) else size).cast("int").alias("size"),
        F.transform("_e", lambda e: e["_i"]).alias("indices"),
        F.transform("_e", lambda e: e["_w"]).alias("values"),
    )


def assemble_sparse(rows: DataFrame, out: str = "features", *, append_one: bool = False,
                    sign_col: str | None = None) -> DataFrame:
    """ML ``SparseVector`` column from (size, indices, values), without Python per row; the two arrays go into it.

    The vectors are built as plain structs by column functions, written to the shared folder and
    read back under the vector type, whose stored form is that struct. Optional: append a
    constant 1 feature (index = size) and multiply the whole vector by a +-1 sign column (used by
    the penalised-intercept fit)."""
    from pyspark.ml.linalg import VectorUDT

    one = int(append_one)
    idx, val = F.col("indices"), F.col("values")
    if append_one:
        idx, val = F.concat(idx, F.array(F.col("size"))), F.concat(val, F.array(F.lit(1.0)))
    if sign_col:
        val = F.transform(val, lambda x: x * F.col(sign_col))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), (F.col("size") + one).cast("int").alias("size"),
                      idx.cast("array<int>").alias("indices"), val.cast("array<double>").alias("values"))
    plain = rows.withColumn(out, vector).drop("indices", "values")
    path = scratch_path(rows.sparkSession, "vectors")
    with shuffles_freed(rows.sparkSession):
        plain.write.option("compression", "zstd").parquet(path)
    schema = StructType([StructField(f.name, VectorUDT() if f.name == out else f.dataType) for f in plain.schema])
    return rows.sparkSession.read.schema(schema).parquet(path)


def sparse_entries(df: DataFrame, col: str) -> DataFrame:
    """(row_id, size, indices, values) of a sparse vector column, read as its stored struct."""
    path = scratch_path(df.sparkSession, "entries")
    with shuffles_freed(df.sparkSession):
        df.select("row_id", col).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(
        f"row_id long, {col} struct<type:tinyint,size:int,indices:array<int>,values:array<double>>").parquet(path).select(
        "row_id", f"{col}.size", f"{col}.indices", f"{col}.values")


def with_l2_normalized(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Row L2 normalisation of an array column (as double); zero vectors stay zero.

    The norm is materialised as its own column first so the element lambda only
    references a column."""
    out = out or col
    df = df.withColumn("_l2", F.sqrt(F.aggregate(F.col(col), F.lit(0.0),
                                                 lambda acc, x: acc + x.cast("double") * x.cast("double"))))
    n = F.col("_l2")
    return df.withColumn(
        out, F.transform(F.col(col), lambda x: F.when(n == 0, x.cast("double")).otherwise(x.cast("double") / n))
    ).drop("_l2")


def _gram_times(block: Block, out: list[np.ndarray], q: np.ndarray) -> None:
    """Add X'(X q) of the block's rows."""
    w = out[0].reshape(q.shape)
    ends = np.cumsum(block.sizes)
    for lo, hi in zip((ends - block.sizes).tolist(), ends.tolist(), strict=True):
        if hi > lo:
            i, x = block.indices[lo:hi], block.entries[lo:hi]
            w[i] += np.outer(x, x @ q[i])


def truncated_svd(blocks: DataFrame, d: int, k: int, *, oversample: int = 20, tol: float = 1e-11, max_passes: int = 60,
                  seed: int = 42) -> tuple[np.ndarray, np.ndarray, int]:
    """(V, singular values, passes): the ``k`` largest of the packed rows X with ``d`` columns.

    A randomised range finder: a random d x (k + oversample) block is multiplied by X'X again and
    again, one pass over the rows each, and the blocks so found are made orthonormal one after the
    other. Each pass gives the Rayleigh-Ritz values of the space so far; it ends when the residuals
    of the ``k`` largest vanish or nothing new is found. A task holds one such
    block, the driver the few blocks and their products, never a d x d array.
    """
    width, tasks = min(k + oversample, d), partitions(blocks)
    rng = np.random.default_rng(seed)
    basis, images = np.zeros((d, 0)), np.zeros((d, 0))
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    for passes in range(1, max_passes + 1):
        image = summed(blocks, _gram_times, [q.size], q, tasks=tasks)[0].reshape(q.shape)
        basis, images = np.hstack([basis, q]), np.hstack([images, image])
        small = basis.T @ images
        values, ritz = np.linalg.eigh((small + small.T) / 2)
        values, ritz = values[::-1][:k], ritz[:, ::-1][:, :k]
        residual = np.linalg.norm(images @ ritz - (basis @ ritz) * values, axis=0).max(initial=0.0)
        if residual <= tol * max(values[0], 1e-300) or basis.shape[1] >= d:
            break
        # What the image adds to the space; twice, for orthogonality in floating point.
        fresh = image - basis @ (basis.T @ image)
        fresh -= basis @ (basis.T @ fresh)
        u, size, _ = np.linalg.svd(fresh, full_matrices=False)
        q = u[:, size > 1e-13 * max(values[0], 1e-300)][:, :d - basis.shape[1]]
        if not q.shape[1]:
            break
        q = np.linalg.qr(q - basis @ (basis.T @ q))[0]
    return basis @ ritz, np.sqrt(np.clip(values, 0.0, None)), passes


def lsa_embed(df: DataFrame, *, dimensions: int = 100, max_features: int = 5000, min_df: int = 2,
              stopwords: Sequence[str] | None = None, text_col: str = "text") -> tuple[DataFrame, dict]:
    """Latent semantic embeddings: TF-IDF (stopwords removed, 1-2-grams, min_df,
    max_features) -> truncated SVD without centring -> X.V -> L2 normalise -> float32.

    The SVD works on packed rows of all partitions (``truncated_svd``); the projection is a
    vectorised product per Arrow batch with V broadcast (d x k)."""
    from pyspark.ml.feature import StopWordsRemover

    if dimensions < 2:
        raise EmbeddingError("LSA needs at least 2 dimensions")
    stop = list(stopwords) if stopwords is not None else StopWordsRemover.loadDefaultStopWords("english")
    terms = on_files(with_terms(df, text_col=text_col, stopwords=stop).select("row_id", "terms"), "terms")
    vocab = cut_lineage(build_vocabulary(terms, min_df=min_df, max_features=max_features))
    d = vocab.count()
    if d < 2:
        raise EmbeddingError(f"LSA needs at least 2 features; the texts have {d}")
    n = terms.count()
    k = int(min(dimensions, d - 1, n - 1))
    rows = cut_lineage(to_sparse_rows(tfidf_transform(terms, vocab, broadcast_vocab=True), d).select("row_id", "indices", "values"))
    blocks = pack_rows(rows.select("indices", "values", F.lit(0.0).alias("y"), F.lit(0.0).alias("s"))).persist(StorageLevel.MEMORY_AND_DISK)
    v, sigma, passes = truncated_svd(blocks, d, k)
    blocks.unpersist()
    bv = df.sparkSession.sparkContext.broadcast(v)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vv = bv.value
        for pdf in batches:
            out = np.zeros((len(pdf), vv.shape[1]))
            for i, (idx, vals) in enumerate(zip(pdf["indices"], pdf["values"])):
                if idx is not None and len(idx):
                    out[i] = np.asarray(vals, dtype=np.float64) @ vv[np.asarray(idx, dtype=np.int64)]
            nrm = np.linalg.norm(out, axis=1, keepdims=True)
            out = np.where(nrm > 0, out / np.where(nrm > 0, nrm, 1), out).astype(np.float32)
            yield pd.DataFrame({"row_id": pdf["row_id"].to_numpy(), "embedding": list(out)})

    schema = StructType([StructField("row_id", LongType()), StructField("embedding", ArrayType(FloatType()))])
    emb = rows.mapInPandas(project, schema)
    meta = {"features": int(d), "components": k, "singular_values": sigma.tolist(), "rows": int(n), "passes": passes}
    return emb, meta


def md5_embedder(dims: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """Deterministic offline embedder: each white-space word of the lower-cased text adds one to
    the dimension md5(word) mod ``dims``; no normalisation, so the values are whole numbers."""
    import hashlib

    def embed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dims))
        for i, t in enumerate(texts):
            for w in (t or "").lower().split():
                out[i, int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dims] += 1.0
        return out.tolist()

    return embed


class RetryableError(Exception):
    """A failure of an embedding provider that may pass: timeouts, rate limits, 5xx."""


def placed(response: Sequence, n: int) -> list[list[float]]:
    """The vectors of a response in the order of its request.

    A response is a list of vectors in that order, or of (index, vector) pairs in any order; each
    index of the request must come exactly once."""
    if response and isinstance(response[0], tuple):
        out: list[list[float] | None] = [None] * n
        for index, vector in response:
            if not 0 <= index < n or out[index] is not None:
                raise EmbeddingError(f"index {index} of a response for {n} texts is repeated or out of range")
            out[index] = vector
        absent = [i for i, v in enumerate(out) if v is None]
        if absent:
            raise EmbeddingError(f"embedding count {n - len(absent)} != batch size {n}; no vector for the indices {absent[:10]}")
        return out
    if len(response) != n:
        raise EmbeddingError(f"embedding count {len(response)} != batch size {n}")
    return list(response)


def batch_embed(df: DataFrame, embed: Callable[[list[str]], Sequence], *, batch_size: int = 64,
                retries: int = 4, text_col: str = "text", id_col: str = "row_id",
                retryable: tuple[type[Exception], ...] = (RetryableError, TimeoutError, ConnectionError),
                sleep: Callable[[float], None] | None = None, in_flight: int = 1) -> DataFrame:
    """Embed texts with an injected callable in batches of ``batch_size`` inside each partition.

    A partition keeps at most ``in_flight`` requests under way (threads: the callable waits for a
    remote service) and takes their results in the order of its rows, so results stay keyed by
    ``row_id``, whatever order requests end in and responses have (``placed``). Wrong responses
    are errors; ``retryable`` failures are retried with backoff min(2^attempt, 8) s and all others
    end the job at once. Requests that have not begun then are given up."""
    import time
    from collections import deque
    from concurrent.futures import ThreadPoolExecutor

    wait = sleep or time.sleep

    def call(batch: list[str]) -> list[list[float]]:
        for attempt in range(retries + 1):
            try:
                return placed(embed(batch), len(batch))
            except retryable:
                if attempt == retries:
                    raise
                wait(min(2 ** attempt, 8))
        raise AssertionError("unreachable")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(max_workers=in_flight)
        try:
            for pdf in batches:
                texts = pdf[text_col].fillna("").astype(str).tolist()
                vecs: list[list[float]] = []
                window: deque = deque()
                for s in range(0, len(texts), batch_size):
                    if len(window) == in_flight:
                        vecs.extend(window.popleft().result())
                    window.append(pool.submit(call, texts[s:s + batch_size]))
                while window:
                    vecs.extend(window.popleft().result())
                yield pd.DataFrame({id_col: pdf[id_col].to_numpy(),
                                    "embedding": [np.asarray(v, dtype=np.float32) for v in vecs]})
        finally:
            pool.shutdown(wait=True, cancel_futures=True)

    schema = StructType([StructField(id_col, LongType()), StructField("embedding", ArrayType(FloatType()))])
    return df.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInPandas(run, schema)
