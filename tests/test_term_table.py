import math
import os
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from msgsift.operators import classify as CL
from msgsift.operators import features as FT
from msgsift.operators import newton
from msgsift.operators import packing as PK
from msgsift.operators import term_table as T
from msgsift.plans import queries
from msgsift.session import cut_lineage, on_files
from msgsift.streaming import score
from tests.test_io_classify import REQUEST_SCHEMA, REQUESTS, SCHEMA, TRAIN, _facts, _newton

TERMS = "row_id long, terms array<string>"
WORDS = ["", "a", "ab", "b c", "é", "日本", "x" * 300, "a b", "zz"] + [f"w{k}" for k in range(40)]


def _rows():
    r = random.Random(1)
    rows = [(i, [r.choice(WORDS) for _ in range(r.randrange(0, 30))]) for i in range(80)]
    return rows + [(3, ["a", "a", None]), (None, ["a", "zz"]), (None, ["zz", "w1"]), (900, []), (901, None), (902, ["never seen"]), (903, [None])]


def _expected(rows, min_df):
    df, total = Counter(), Counter()
    for i, terms in rows:
        tf = Counter(t for t in terms or [] if t is not None)
        total.update(tf)
        df.update(t for t in tf if i is not None)
    idf = {t: math.log((1 + len(rows)) / (1 + n)) + 1 for t, n in df.items() if n >= min_df}
    by_id = defaultdict(Counter)
    for i, terms in rows:
        by_id[i].update(t for t in terms or [] if t in idf)
    out = {}
    for i, tf in by_id.items():
        w = {t: (1 + math.log(n)) * idf[t] for t, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / norm for t, x in w.items()} or {(i, None): None})
    return {t: (df[t], total[t]) for t in idf}, out


def _shuffles(spark):
    """Shuffle files on disk; they are removed soon after their query, not within it."""
    found = set()
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for _, _, names in os.walk(top.getPath()):
            found |= {n for n in names if n.startswith("shuffle_")}
    return found


def _left(spark, before):
    for _ in range(50):
        if not _shuffles(spark) - before:
            return set()
        time.sleep(0.1)
    return _shuffles(spark) - before


@pytest.mark.parametrize("repeats", [True, False])
def test_packed_weights_equal_brute_force(spark, repeats):
    rows = [r for k, r in enumerate(_rows()) if repeats or r[0] is not None and k != 80]
    df = on_files(spark.createDataFrame(rows, TERMS).repartition(3), "rows")
    vocab = cut_lineage(FT.build_vocabulary(df, min_df=2))
    stats, weights = _expected(rows, 2)
    assert {r.term: (r.df, r.tf_total) for r in vocab.collect()} == stats
    assert [r.term for r in vocab.orderBy("idx").collect()] == sorted(stats, key=lambda t: t.encode())
    long = FT.tfidf_transform(df, vocab)
    got = {(r.row_id, r.term): r.weight for r in long.collect()}
    assert got.keys() == weights.keys() and long.count() == len(weights)
    assert all(got[k] is None if w is None else abs(got[k] - w) < 1e-12 for k, w in weights.items())
    assert FT.tfidf_transform(df, vocab, term=False).columns == ["row_id", "idx", "weight"]
    # Rows with an id of their own are not shuffled term by term.
    if not repeats:
        plan = long._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "Window" not in plan


def test_pieces_keep_every_row(monkeypatch):
    monkeypatch.setattr(T, "PIECE", 7)
    rows = _rows()
    batches = [pa.RecordBatch.from_arrays([pa.array([i for i, _ in some], pa.int64()), pa.array([t for _, t in some], pa.list_(pa.string()))], ["i", "t"])
               for some in (rows[:50], rows[50:51], rows[51:])]
    got, counts = [], Counter()
    for ids, lists in T.pieces(iter(batches)):
        got += list(zip(ids.to_pylist(), lists.to_pylist(), strict=True))
        row, code, tf, terms, bounds = T.counted(lists, 4)
        assert sum(hi - lo for _, lo, hi in bounds) == len(terms)
        for p, lo, hi in bounds:
            part = terms.slice(lo, hi - lo)
            assert set(T.parts_of(part, 4).tolist()) == {p} and part.to_pylist() == sorted(part.to_pylist(), key=lambda t: t.encode())
        for k, c, n in zip(row, code, tf, strict=True):
            counts[len(got) - len(ids) + int(k), terms[int(c)].as_py()] += int(n)
    assert got == rows
    assert counts == Counter((k, t) for k, (_, terms) in enumerate(rows) for t in terms or [] if t is not None)


def test_arrays_survive_packing():
    for a in (np.array([], np.int32), np.array([5, 9, 9, 2_000_000_000]), np.array([0.5, 0.5, 0.5, 0.25, 0.5]), np.array([0.1, -2.0])):
        assert np.array_equal(PK.unpack_values(*PK.unpack_arrays(PK.pack_arrays(*PK.pack_values(a)))), a)


def test_tables_on_files_leave_no_shuffle(spark):
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = _shuffles(spark)
    on_files(counts, "counts")
    cut_lineage(counts.select("k"))
    assert not _left(spark, before)


def test_vectors_hold_their_arrays_once(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "a"]), (3, ["c"])], TERMS)
    vocab = cut_lineage(FT.build_vocabulary(df, min_df=2))
    vec = FT.assemble_sparse(FT.to_sparse_rows(FT.tfidf_transform(df, vocab, term=False), vocab.count()))
    assert vec.columns == ["row_id", "size", "features"]
    got = {r.row_id: r.features for r in vec.collect()}
    assert got[1].indices.tolist() == [0, 1] and got[3].indices.tolist() == [] and got[2].size == 2
    assert abs(got[1].values[0] - (1 + math.log(2)) / math.hypot(1 + math.log(2), 1)) < 1e-12


def _tables(spark, path):
    words = ["free", "prize", "claim", "home", "later", "see", "you"]
    docs = [(i, " ".join(words[(i * k + k) % 7] for k in range(1, 8)) if i else None) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(50)], "doc_id long, quality long, toxic long").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "free prize"), (2, "see you"), (3, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_fits_use_every_row(spark, tmpdir_path, monkeypatch):
    """No fit asks for a part of its rows, in any of the queries."""
    def no(*a, **kw):
        raise AssertionError("a sample was asked for")

    monkeypatch.setattr(CL, "bounded_rows", no)
    sf = _tables(spark, f"{tmpdir_path}/sf")
    got = queries.QUERIES["fit_classifier"](spark, sf).first()
    assert got.rows == 40 and got.gradient_vanishes
    for name, rows in (("fit_then_load", 10), ("fit_then_predict", 3), ("fit_then_score", 10), ("fit_then_stream", 60)):
        assert queries.QUERIES[name](spark, sf).count() == rows


def test_a_fit_with_few_directions_equals_newton(spark, monkeypatch):
    monkeypatch.setattr(newton, "RANK_NUMBERS", 1)
    words = ["alpha", "beta", "gamma", "delta", "prize", "claim", "home", "later"]
    rows = [(i, "spam" if i % 3 == 0 else "ham", " ".join(words[(i * k + k * k) % 8] for k in range(1, 6))) for i in range(60)]
    train = spark.createDataFrame(rows, SCHEMA)
    clf = CL.fit_classifier(train)
    weights = clf.weights.orderBy("idx").toPandas()
    long = FT.tfidf_transform(FT.with_terms(train), clf.weights).toPandas().dropna()
    x = np.zeros((60, len(weights)))
    x[long["row_id"].astype(int), long["idx"].astype(int)] = long["weight"]
    y = np.array([r[1] == "spam" for r in rows], float)
    exact = _newton(x, y, np.where(y > 0, 60 / (2 * y.sum()), 60 / (2 * (60 - y.sum()))))
    assert np.abs(np.append(weights["coefficient"], clf.intercept) - exact).max() < 1e-5


def test_slices_of_a_micro_batch_give_the_same_scores(spark, tmpdir_path, monkeypatch):
    clf = CL.fit_classifier(spark.createDataFrame(TRAIN, SCHEMA))
    want = _facts(score.score_requests(clf, spark.createDataFrame(REQUESTS, REQUEST_SCHEMA)))
    monkeypatch.setattr(CL, "IN_ROW_TERMS", 2)
    monkeypatch.setattr(score, "SLICE", 12)
    for k in range(3):
        spark.createDataFrame(REQUESTS[k::3], REQUEST_SCHEMA).coalesce(1).write.mode("append").json(f"{tmpdir_path}/in")
    src = spark.readStream.schema(REQUEST_SCHEMA).json(f"{tmpdir_path}/in")
    before = _shuffles(spark)
    score.stream_score(clf, src, f"{tmpdir_path}/out", f"{tmpdir_path}/ck").awaitTermination()
    assert not _left(spark, before)
    assert _facts(score.read_scores(spark, f"{tmpdir_path}/out")) == want
