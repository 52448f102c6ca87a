"""Embedding operators: order, batches, errors, retries, and LSA against numpy."""

import numpy as np
import pytest
from pyspark.errors import PythonException

from msgsift.operators import features as FT


def _texts(spark, n=5):
    return spark.createDataFrame([(i, f"word{i} shared text") for i in range(n)], "row_id long, text string").coalesce(1)


def test_batches_and_order(spark):
    def sizes(batch):
        return [[float(len(batch)), float(t.split()[0][4:])] for t in batch]

    got = {r.row_id: r.embedding for r in FT.batch_embed(_texts(spark), sizes, batch_size=2).collect()}
    assert got == {0: [2.0, 0.0], 1: [2.0, 1.0], 2: [2.0, 2.0], 3: [2.0, 3.0], 4: [1.0, 4.0]}
    one = FT.batch_embed(_texts(spark, 6), FT.md5_embedder(3), batch_size=4).orderBy("row_id").collect()
    many = FT.batch_embed(_texts(spark, 6).repartition(3), FT.md5_embedder(3), batch_size=4).orderBy("row_id").collect()
    assert one == many and len(one[0].embedding) == 3


def test_wrong_number_of_vectors_is_an_error(spark):
    with pytest.raises(PythonException, match="embedding count"):
        FT.batch_embed(_texts(spark), lambda batch: [[1.0]], batch_size=2).collect()


def test_requests_in_flight_and_shuffled_responses(spark, tmpdir_path):
    """Responses come as (index, vector) pairs in any order, requests end in any order; rows keep theirs."""
    log = f"{tmpdir_path}/log"

    def embed(batch):
        import random
        import threading
        import time
        with open(log, "a") as f:
            f.write(f"+{threading.get_ident()}\n")
        time.sleep(random.random() * 0.05)
        out = [(i, [float(t.split()[0][4:])]) for i, t in enumerate(batch)]
        random.shuffle(out)
        with open(log, "a") as f:
            f.write(f"-{threading.get_ident()}\n")
        return out

    got = FT.batch_embed(_texts(spark, 60), embed, batch_size=4, in_flight=5).collect()
    assert [(r.row_id, r.embedding) for r in got] == [(i, [float(i)]) for i in range(60)]
    now = most = 0
    for line in open(log):
        now += 1 if line[0] == "+" else -1
        most = max(most, now)
    assert 1 < most <= 5
    for wrong in ([(0, [1.0])], [(0, [1.0]), (0, [2.0])], [(0, [1.0]), (2, [2.0])], [(1, [1.0]), (-1, [2.0])]):
        with pytest.raises(FT.EmbeddingError):
            FT.placed(wrong, 2)
    assert FT.placed([], 0) == [] and FT.placed([(1, [1.0]), (0, [0.0])], 2) == [[0.0], [1.0]]
    with pytest.raises(PythonException, match="no vector for the indices"):
        FT.batch_embed(_texts(spark), lambda b: [(0, [1.0])], batch_size=2, in_flight=3).collect()


def test_only_listed_failures_are_retried(spark):
    def flaky(fails, error):
        left = [fails]

        def embed(batch):
            if left[0]:
                left[0] -= 1
                raise error
            return [[1.0] for _ in batch]

        return embed

    ok = FT.batch_embed(_texts(spark), flaky(4, TimeoutError("slow")), sleep=lambda s: None).collect()
    assert len(ok) == 5
    with pytest.raises(PythonException, match="slow"):
        FT.batch_embed(_texts(spark), flaky(5, TimeoutError("slow")), sleep=lambda s: None).collect()
    with pytest.raises(PythonException, match="broken"):
        FT.batch_embed(_texts(spark), flaky(1, ValueError("broken")), sleep=lambda s: None).collect()


def test_lsa_equals_numpy_svd(spark):
    words = ["alpha", "beta", "gamma", "delta", "prize", "claim", "home", "later"]
    rows = [(i, " ".join(words[(i * k + k) % 8] for k in range(1, 7))) for i in range(30)] + [(30, "unseen")]
    df = spark.createDataFrame(rows, "row_id long, text string").repartition(3)
    emb, meta = FT.lsa_embed(df, dimensions=4, stopwords=["alpha"])
    terms = FT.with_terms(df, stopwords=["alpha"])
    long = FT.tfidf_transform(terms, FT.build_vocabulary(terms, max_features=5000)).toPandas().dropna()
    x = np.zeros((31, meta["features"]))
    x[long["row_id"].astype(int), long["idx"].astype(int)] = long["weight"]
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(meta["singular_values"], s[:4], atol=1e-8)
    want = u[:, :4] * s[:4]
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    want = np.where(norm > 1e-9, want / np.where(norm > 0, norm, 1), 0)
    got = np.array([r.embedding for r in emb.orderBy("row_id").collect()])
    # Signs of components are free: compare the similarities between rows.
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-4)
    with pytest.raises(FT.EmbeddingError):
        FT.lsa_embed(df, dimensions=1)
    with pytest.raises(FT.EmbeddingError):
        FT.lsa_embed(spark.createDataFrame([(1, "a b"), (2, "c d")], "row_id long, text string"))


def test_lsa_of_a_table_equals_numpy_svd(spark):
    """Singular values and projections at sf0.01 within 1e-6; the row vectors are as many as the texts."""
    from msgsift.functions.text import DEFAULT_STOPWORDS
    from msgsift.sources.tables import labelled_messages
    df = labelled_messages(spark, "/root/testdata/sf0.01")
    emb, meta = FT.lsa_embed(df, stopwords=sorted(DEFAULT_STOPWORDS))
    terms = FT.with_terms(df, stopwords=sorted(DEFAULT_STOPWORDS))
    long = FT.tfidf_transform(terms, FT.build_vocabulary(terms, max_features=5000)).toPandas().dropna()
    got = {r.row_id: np.array(r.embedding) for r in emb.collect()}
    ids = sorted(got)
    at = {r: i for i, r in enumerate(ids)}
    x = np.zeros((len(ids), meta["features"]))
    x[[at[r] for r in long["row_id"]], long["idx"].astype(int)] = long["weight"]
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    assert np.abs(np.array(meta["singular_values"]) - s[:100]).max() < 1e-6
    want = u[:, :100] * s[:100]
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    want = np.where(norm > 1e-9, want / np.where(norm > 0, norm, 1), 0)
    have = np.array([got[r] for r in ids])
    assert np.abs(have @ have.T - want @ want.T).max() < 1e-6 and meta["passes"] < 30


def test_rows_that_share_an_id_are_added_in_few_shuffles(spark):
    rows = [(1, ["a", "a", "b"]), (1, ["a", "c"]), (2, ["zzz"]), (2, []), (None, ["b"]), (3, None)]
    df = spark.createDataFrame(rows, "row_id long, terms array<string>")
    vocab = spark.createDataFrame([(0, "a", 1.0), (1, "b", 2.0)], "idx int, term string, idf double")
    out = FT.tfidf_transform(df, vocab)
    got = {(r.row_id, r.term): r.weight for r in out.collect()}
    wa, wb = 1 + np.log(3), 2.0
    norm = np.hypot(wa, wb)
    want = {(1, "a"): wa / norm, (1, "b"): wb / norm, (2, None): None, (None, "b"): 1.0, (3, None): None}
    assert got.keys() == want.keys() and all(want[k] is None and got[k] is None or abs(got[k] - want[k]) < 1e-12 for k in want)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 0
