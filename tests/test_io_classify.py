import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from msgsift.operators import classify as CL
from msgsift.operators import features as FT
from msgsift.operators import quality as Q
from msgsift.sources.delimited import read_messages, resolve_columns
from msgsift.operators.stage import TextClassifierStage, TextScorer
from msgsift.plans import queries
from msgsift.sources.tables import read_table
from msgsift.streaming.score import read_scores, score_requests, stream_score
from tests.conftest import SF


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_headerless_tsv_and_header_csv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "raw")
    _write(p, "ham\tsee you later\nspam\tFREE prize, claim now\n1\twin cash\n")
    df, opts = read_messages(spark, p)
    assert opts.delimiter == "\t" and not opts.header
    assert resolve_columns(df) == ("label", "text")
    assert [r.text for r in df.orderBy("_order").collect()] == ["see you later", "FREE prize, claim now", "win cash"]

    q = os.path.join(tmpdir_path, "withheader.csv")
    _write(q, "v1,v2,extra\nham,hello there,x\nspam,buy now,y\n")
    df2, opts2 = read_messages(spark, q)
    assert opts2.delimiter == "," and opts2.header
    assert resolve_columns(df2) == ("v1", "v2")


def test_bad_label_file_raises(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad")
    _write(p, "ham\tfine\nmaybe\twhat\n")
    df, _ = read_messages(spark, p)
    lab, txt = resolve_columns(df)
    with pytest.raises(Q.DatasetValidationError):
        Q.enforce_quality(df, label_col=lab, text_col=txt)


TRAIN = [(1, "spam", "free prize now"), (2, "spam", "free prize claim"), (3, "ham", "see you at home"), (4, "ham", "see you later")]
SCHEMA = "row_id long, label string, text string"


def test_classifier_confidence(spark):
    clf = CL.fit_classifier(spark.createDataFrame(TRAIN, SCHEMA))
    new = spark.createDataFrame([(10, "claim your free prize"), (11, "see you soon"), (12, "   "), (13, "unknown words")], "row_id long, text string")
    out = {r.row_id: r for r in CL.predict_confidence(clf, new).collect()}
    assert out[10].label == "spam" and out[11].label == "ham"
    assert all(0.5 <= out[i].confidence <= 1.0 for i in (10, 11, 13))
    assert out[12].rejected and out[12].label is None


def _newton(x, y, w):
    """Exact minimiser of sum w log(1 + exp(-y z)) + |b|^2 / 2, the constant feature included."""
    x = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ b)))
        g = x.T @ (w * (p - y)) + b
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(len(b))
        step = np.linalg.solve(h, g)
        b -= step
        if np.abs(step).max() < 1e-13:
            return b
    raise AssertionError


def test_fit_equals_newton(spark):
    words = ["alpha", "beta", "gamma", "delta", "prize", "claim", "home", "later"]
    rows = [(i, "spam" if i % 3 == 0 else "ham", " ".join(words[(i * k + k * k) % 8] for k in range(1, 6))) for i in range(60)]
    train = spark.createDataFrame(rows, SCHEMA)
    clf = CL.fit_classifier(train)
    weights = clf.weights.orderBy("idx").toPandas()
    long = FT.tfidf_transform(FT.with_terms(train), clf.weights).toPandas().dropna()
    x = np.zeros((60, len(weights)))
    x[long["row_id"].astype(int), long["idx"].astype(int)] = long["weight"]
    y = np.array([r[1] == "spam" for r in rows], float)
    w = np.where(y > 0, 60 / (2 * y.sum()), 60 / (2 * (60 - y.sum())))
    exact = _newton(x, y, w)
    assert np.abs(np.append(weights["coefficient"], clf.intercept) - exact).max() < 1e-5
    p = 1 / (1 + np.exp(-(x @ exact[:-1] + exact[-1])))
    got = CL.score_messages(clf, train).orderBy("row_id").toPandas()["spam_probability"]
    assert np.abs(got - p).max() < 1e-6
    assert CL.fit_report(clf, train).first().gradient_vanishes


def test_fit_bounds_its_rows(spark):
    train = spark.createDataFrame([(i, lab, text) for i, (_, lab, text) in enumerate(TRAIN * 10)], SCHEMA)
    assert CL.bounded_rows(train, 40).count() == 40
    first = CL.bounded_rows(train, 7).select("row_id").orderBy("row_id").collect()
    assert len(first) == 7 and first == CL.bounded_rows(train.repartition(5), 7).select("row_id").orderBy("row_id").collect()


def test_fingerprint_tells_rows_apart(spark):
    def fp(rows):
        return CL.corpus_fingerprint(spark.createDataFrame(rows, "label string, text string")).first().fingerprint

    train = spark.createDataFrame(TRAIN, SCHEMA)
    known = CL.corpus_fingerprint(train).first()
    assert known.rows == 4
    CL.verify_fingerprint(train.orderBy(F.desc("row_id")), known.fingerprint)
    with pytest.raises(CL.ModelError):
        CL.verify_fingerprint(train.withColumn("text", F.when(F.col("row_id") == 1, "free prize later").otherwise(F.col("text"))), known.fingerprint)
    assert len({fp(r) for r in ([("a\tb", "c")], [("a", "b\tc")], [("a", None)], [(None, "a")], [("a", "")], [("a", "n")])}) == 6
    assert fp([("a", "b"), ("a", "b")]) != fp([("a", "b")])


def test_tree_descent_finds_changed_rows(spark, tmpdir_path):
    from msgsift.operators import merkle as M
    rows = [(i, "ham" if i % 2 else "spam", f"text {i // 2}") for i in range(300)] + [(900, None, None), (901, None, None)]
    one = spark.createDataFrame(rows, SCHEMA)
    other = spark.createDataFrame([(i, lab, "new" if i == 7 else text) for i, lab, text in rows if i not in (20, 900)] + [(999, "ham", "added")], SCHEMA)
    for name, df in (("a", one), ("b", other), ("c", one.orderBy(F.desc("row_id"))), ("none", one.where("false"))):
        M.write_tree(M.digest_tree(df), f"{tmpdir_path}/{name}")
    assert M.differing_leaves(spark, f"{tmpdir_path}/a", f"{tmpdir_path}/c").count() == 0
    leaves = M.differing_leaves(spark, f"{tmpdir_path}/a", f"{tmpdir_path}/b")
    gone = {r.row_id for r in M.rows_in(one, leaves).collect()} - {r.row_id for r in M.rows_in(other, leaves).collect()}
    assert gone == {20, 900}
    digests = {r.h[:4] for r in M.row_digests(one.where("row_id IN (7, 20, 900)").unionByName(other.where("row_id IN (7, 999)"))).collect()}
    assert {r.prefix for r in leaves.collect()} == digests
    assert M.differing_leaves(spark, f"{tmpdir_path}/a", f"{tmpdir_path}/none").agg(F.sum("rows")).first()[0] == 302
    root = spark.read.parquet(f"{tmpdir_path}/none").collect()
    assert [(r.level, r.rows) for r in root] == [(0, 0)]


def test_model_round_trip_and_failures(spark, tmpdir_path):
    clf = CL.fit_classifier(spark.createDataFrame(TRAIN, SCHEMA))
    path = os.path.join(tmpdir_path, "model")
    CL.persist_model(clf, path, {"note": "x"})
    back = CL.load_model(spark, path)
    rows = spark.createDataFrame(TRAIN, SCHEMA)
    assert CL.score_messages(back, rows).orderBy("row_id").collect() == CL.score_messages(clf, rows).orderBy("row_id").collect()
    with pytest.raises(CL.ModelError):
        CL.load_model(spark, os.path.join(tmpdir_path, "nothing"))
    for broken in (clf.weights.drop("idf"), clf.weights.where("false"), clf.weights.union(clf.weights),
                   clf.weights.withColumn("coefficient", F.lit(float("nan")))):
        bad = os.path.join(tmpdir_path, f"bad{id(broken)}")
        CL.persist_model(CL.TextClassifier(broken, 0.0), bad)
        with pytest.raises(CL.ModelError):
            CL.load_model(spark, bad)
    CL.persist_model(CL.TextClassifier(clf.weights, 0.0, ("ham",), "spam"), path)
    with pytest.raises(CL.ModelError):
        CL.load_model(spark, path)


def _exact_model(spark, train):
    """(terms -> index, idf, weights with the intercept last) by dense Newton steps in numpy."""
    terms = [(r.row_id, r.label, r.terms) for r in FT.with_terms(train).select("row_id", "label", "terms").collect()]
    n, df = len(terms), {}
    for _, _, t in terms:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    index = {t: i for i, t in enumerate(sorted(t for t, c in df.items() if c >= 2))}
    idf = np.array([np.log((1 + n) / (1 + df[t])) + 1 for t in index])
    x = np.array([_row(t, index, idf) for _, _, t in terms])
    y = np.array([lab == "spam" for _, lab, _ in terms], float)
    w = np.where(y > 0, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    # The dual form keeps the system as small as the number of rows.
    xb = np.hstack([x, np.ones((n, 1))])
    gram, m = xb @ xb.T, np.zeros(n)
    for _ in range(60):
        p = 1 / (1 + np.exp(-m))
        d = w * p * (1 - p)
        a = np.linalg.solve(np.eye(n) + d[:, None] * gram, d * m - w * (p - y))
        new = gram @ a
        if np.abs(new - m).max() < 1e-12:
            return index, idf, xb.T @ a
        m = new
    raise AssertionError


def _row(terms, index, idf):
    v = np.zeros(len(index))
    for t in terms:
        if t in index:
            v[index[t]] += 1
    v = np.where(v > 0, 1 + np.log(np.where(v > 0, v, 1)), 0) * idf
    return v / (np.linalg.norm(v) or 1.0)


def test_fitted_queries_equal_numpy(spark):
    """Fit-then-score, -predict, -load and -stream against margins of exact weights."""
    sp = queries.split_messages(spark, SF, "row")
    index, idf, b = _exact_model(spark, sp.where("split = 'train'").select("row_id", "label", "text"))

    def margins(df):
        rows = FT.with_terms(df).collect()
        return {r[0]: float(_row(r.terms, index, idf) @ b[:-1] + b[-1]) for r in rows}

    test = margins(sp.where("split = 'test'").select("row_id", "text"))
    for name in ("fit_then_score", "fit_then_load"):
        got = queries.QUERIES[name](spark, SF).collect()
        assert sorted(r.row_id for r in got) == sorted(test) and {r.true_label for r in got} == {"ham", "spam"}
        assert all(abs(r.spam_probability - 1 / (1 + np.exp(-test[r.row_id]))) < 1e-6 for r in got)
        assert all(r.predicted_label == ("spam" if test[r.row_id] > 0 else "ham") for r in got)
    bench = margins(read_table(spark, SF, "benchmark").select(F.col("item_id").alias("row_id"), "text"))
    got = queries.QUERIES["fit_then_predict"](spark, SF).collect()
    assert len(got) == len(bench)
    assert all(abs(r.confidence - 1 / (1 + np.exp(-abs(bench[r.row_id])))) < 1e-6 for r in got)
    docs = margins(read_table(spark, SF, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("row_id"), "text"))
    got = queries.QUERIES["fit_then_stream"](spark, SF).collect()
    assert sorted(r.request_id for r in got) == sorted(docs)
    assert all(abs(r.confidence - 1 / (1 + np.exp(-abs(docs[r.request_id])))) < 1e-6 for r in got if r.accepted)
    assert sum(r.accepted for r in got) > len(got) / 2


def test_fit_needs_few_passes(spark):
    train = queries.split_messages(spark, "/root/testdata/sf0.01", "row").where("split = 'train'").select("row_id", "label", "text")
    clf = CL.fit_classifier(train)
    assert clf.passes < 60 and clf.weights.count() > 10_000


def test_pipeline_stage_round_trip_and_damage(spark, tmpdir_path):
    from pyspark.ml import Pipeline, PipelineModel
    model = Pipeline(stages=[TextClassifierStage(predictionCol="said", minDF=1)]).fit(spark.createDataFrame(TRAIN, SCHEMA))
    path = os.path.join(tmpdir_path, "pipe")
    model.save(path)
    new = spark.createDataFrame([(1, "free prize"), (2, "see you"), (3, None), (4, "")], "row_id long, text string")
    other = spark.newSession()
    back = PipelineModel.load(path)
    want = model.transform(new).orderBy("row_id").collect()
    assert back.transform(other.createDataFrame(new.collect(), new.schema)).orderBy("row_id").collect() == want
    assert [r.said for r in want][:2] == ["spam", "ham"] and want[0].asDict().keys() == {"row_id", "text", "spam_probability", "said"}
    clf = model.stages[0].classifier
    for k, broken in enumerate((clf.weights.drop("idf"), clf.weights.where("false"), clf.weights.union(clf.weights),
                                clf.weights.withColumn("coefficient", F.lit(None).cast("double")))):
        TextScorer(CL.TextClassifier(broken, 0.0)).save(f"{tmpdir_path}/bad{k}")
        with pytest.raises(CL.ModelError):
            TextScorer.load(f"{tmpdir_path}/bad{k}")
    TextScorer(CL.TextClassifier(clf.weights, 0.0, ("ham",))).save(f"{tmpdir_path}/bad9")
    for damaged in (f"{tmpdir_path}/bad9", f"{tmpdir_path}/none"):
        with pytest.raises(CL.ModelError):
            TextScorer.load(damaged)


REQUESTS = [("x", "free prize"), ("x", "see you"), (None, "free prize"), (None, "free prize"), ("bad id!", "home"), ("y", " "), ("z", "later"),
            ("x", "free prize")]
REQUEST_SCHEMA = "request_id string, text string"


def _facts(df):
    return sorted((r.request_id if not r.request_id.startswith("gen-") else "gen", r.accepted, r.reject_reason, str(r.label), r.confidence and round(r.confidence, 9))
                  for r in df.collect())


def test_stream_equals_batch_with_repeated_and_missing_ids(spark, tmpdir_path):
    clf = CL.fit_classifier(spark.createDataFrame(TRAIN, SCHEMA))
    for k in range(3):
        spark.createDataFrame(REQUESTS[k::3], REQUEST_SCHEMA).coalesce(1).write.mode("append").json(f"{tmpdir_path}/in")
    src = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmpdir_path}/in")
    q = stream_score(clf, src, f"{tmpdir_path}/out", f"{tmpdir_path}/ck")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmpdir_path}/out")
    assert len([f for f in os.listdir(f"{tmpdir_path}/ck/commits") if f.isdigit()]) == 3
    batch = score_requests(clf, spark.createDataFrame(REQUESTS, REQUEST_SCHEMA))
    assert _facts(got) == _facts(batch) and len(_facts(got)) == len(REQUESTS)
    # The join with the weight table, used on batches, gives the same.
    texts = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(REQUESTS) if t.strip()], "row_id long, text string")
    joined = sorted(round(max(r.spam_probability, 1 - r.spam_probability), 9) for r in CL.score_messages(clf, texts).collect())
    assert joined == sorted(r[4] for r in _facts(batch) if r[1])
    ids = [r.request_id for r in got.collect() if r.request_id.startswith("gen-")]
    assert len(ids) == len(set(ids)) == 3
    plan = score_requests(clf, spark.createDataFrame(REQUESTS, REQUEST_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_restarted_stream_loses_and_repeats_nothing(spark, tmpdir_path):
    """The query dies after the sink took a micro-batch and before it was logged as done."""
    clf = CL.fit_classifier(spark.createDataFrame(TRAIN, SCHEMA))

    def run():
        src = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmpdir_path}/in")
        stream_score(clf, src, f"{tmpdir_path}/out", f"{tmpdir_path}/ck").awaitTermination()

    for k in range(2):
        spark.createDataFrame(REQUESTS[k::3], REQUEST_SCHEMA).coalesce(1).write.mode("append").json(f"{tmpdir_path}/in")
    run()
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{tmpdir_path}/ck/commits/{name}"):
            os.remove(f"{tmpdir_path}/ck/commits/{name}")
    spark.createDataFrame(REQUESTS[2::3], REQUEST_SCHEMA).coalesce(1).write.mode("append").json(f"{tmpdir_path}/in")
    run()
    batch = score_requests(clf, spark.createDataFrame(REQUESTS, REQUEST_SCHEMA))
    assert _facts(spark.read.parquet(f"{tmpdir_path}/out")) == _facts(batch)


def test_large_weight_tables_are_joined(spark, tmpdir_path, monkeypatch):
    """Above ``IN_ROW_TERMS`` no worker holds the table; streams, a restart and stages give the same results."""
    clf = CL.fit_classifier(spark.createDataFrame(TRAIN, SCHEMA))
    batch = _facts(score_requests(clf, spark.createDataFrame(REQUESTS, REQUEST_SCHEMA)))
    new = spark.createDataFrame([(1, "free prize"), (1, "see you"), (None, None), (4, "")], "row_id long, text string")
    stage = [tuple(r) for r in TextScorer(clf).transform(new).collect()]
    monkeypatch.setattr(CL, "IN_ROW_TERMS", 2)
    plan = score_requests(clf, spark.createDataFrame(REQUESTS, REQUEST_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Python" not in plan

    def run():
        src = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmpdir_path}/in")
        stream_score(clf, src, f"{tmpdir_path}/out", f"{tmpdir_path}/ck").awaitTermination()

    for k in range(2):
        spark.createDataFrame(REQUESTS[k::3], REQUEST_SCHEMA).coalesce(1).write.mode("append").json(f"{tmpdir_path}/in")
    run()
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{tmpdir_path}/ck/commits/{name}"):
            os.remove(f"{tmpdir_path}/ck/commits/{name}")
    spark.createDataFrame(REQUESTS[2::3], REQUEST_SCHEMA).coalesce(1).write.mode("append").json(f"{tmpdir_path}/in")
    run()
    assert _facts(read_scores(spark, f"{tmpdir_path}/out")) == batch
    joined = [tuple(r) for r in TextScorer(clf).transform(new).collect()]
    key = lambda r: (str(r[0]), str(r[1]), r[3], round(r[2], 12))
    assert sorted(map(key, joined)) == sorted(map(key, stage))


def test_terms_of_unlabelled_rows_stay_in_the_model(spark):
    rows = [*TRAIN, (5, None, "lonely words"), (6, None, "lonely words")]
    weights = {r.term: r.coefficient for r in CL.fit_classifier(spark.createDataFrame(rows, SCHEMA)).weights.collect()}
    assert weights["lonely words"] == 0.0 and weights["free prize"] > 0


def test_fit_sends_no_vector_of_the_vocabulary_to_the_driver(spark, monkeypatch):
    """Passes return one number per row, whatever the number of terms."""
    from msgsift.operators import newton
    lengths, summed = [], newton.summed_columns

    def spy(blocks, parts, sizes, *arrays, **kw):
        lengths.append((sum(sizes), max(a.size for a in arrays)))
        return summed(blocks, parts, sizes, *arrays, **kw)

    monkeypatch.setattr(newton, "summed_columns", spy)
    rows = [(i, ("spam", "ham")[i % 2], " ".join(f"w{(i // 2 + k) % 400}" for k in range(200))) for i in range(20)]
    clf = CL.fit_classifier(spark.createDataFrame(rows, SCHEMA))
    assert clf.weights.count() > 400 and max(max(x) for x in lengths) <= 20 * 20
    assert CL.fit_report(clf, spark.createDataFrame(rows, SCHEMA)).first().gradient_vanishes
