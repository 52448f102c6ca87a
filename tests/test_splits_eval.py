import math

import numpy as np
from pyspark.sql import functions as F

from msgsift.operators import evaluate as EV
from msgsift.operators import splits as S


def test_stratified_quotas_and_determinism(spark):
    rows = [(i, "spam" if i % 7 == 0 else "ham", f"t{i}") for i in range(1, 400)]
    df = spark.createDataFrame(rows, "row_id long, label string, text string")
    a = S.stratified_split(df).filter("split = 'test'")
    b = S.stratified_split(df.repartition(5)).filter("split = 'test'")
    assert a.count() == math.ceil(0.2 * 399)
    assert sorted(r.row_id for r in a.collect()) == sorted(r.row_id for r in b.collect())


def test_grouped_split_has_no_text_overlap(spark):
    rows = [(i, "spam" if i % 3 == 0 else "ham", f"msg {i % 40}") for i in range(1, 200)]
    df = spark.createDataFrame(rows, "row_id long, label string, text string")
    sp, _seed = S.grouped_split(df)
    lk = S.split_leakage(sp).first()
    assert lk.text_overlap_count == 0 and lk.duplicate_message_rows >= 4


def test_sample_size(spark):
    df = spark.range(1, 101).select(F.col("id").alias("row_id"))
    assert S.sample_messages(df, 10).count() == 10
    assert S.sample_messages(df, 500).count() == 100


def _pred(spark, cm):
    rows, i = [], 0
    for t, p, n in [("ham", "ham", cm[0][0]), ("ham", "spam", cm[0][1]), ("spam", "ham", cm[1][0]), ("spam", "spam", cm[1][1])]:
        for _ in range(n):
            i += 1
            rows.append((i, t, p, 0.9 if p == "spam" else 0.1))
    return EV.prediction_table(spark.createDataFrame(rows, "row_id long, true_label string, predicted_label string, spam_probability double"))


def test_metrics_golden_confusion_matrix(spark):
    m = EV.binary_metrics(_pred(spark, [[960, 6], [7, 142]])).first()
    assert round(m.accuracy, 5) == 0.98834
    assert (round(m.spam_precision, 5), round(m.spam_recall, 5), round(m.spam_f1, 5)) == (0.95946, 0.95302, 0.95623)
    av = EV.averaged_metrics(_pred(spark, [[960, 6], [7, 142]])).first()
    assert round(av.macro_f1, 5) == 0.97475 and round(av.weighted_f1, 5) == 0.98832


def test_zero_predicted_positives(spark):
    m = EV.binary_metrics(_pred(spark, [[5, 0], [3, 0]])).first()
    assert m.spam_precision == 0.0 and m.spam_recall == 0.0 and m.spam_f1 == 0.0


def test_average_precision_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.5 + y * 0.3, 3)  # ties on purpose
    rows = [(i, "spam" if y[i] else "ham", "ham", float(s[i])) for i in range(300)]
    pred = spark.createDataFrame(rows, "row_id long, true_label string, predicted_label string, spam_probability double")
    ap = EV.average_precision(pred).first()[0]
    order = np.argsort(-s, kind="stable")
    P = y.sum()
    brute, prev_r = 0.0, 0.0
    for t in np.unique(s)[::-1]:
        sel = s >= t
        tp, fp = (y[sel] == 1).sum(), (y[sel] == 0).sum()
        r = tp / P
        brute += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    assert abs(ap - brute) < 1e-12 and len(order) == 300
    curve = EV.pr_curve(pred).collect()
    assert len(curve) == len(np.unique(s)) + 1


def test_predictions_read_the_texts_once(spark):
    """The plan of the predictions starts at stored tokens; scores are those of a plain sum, without a text too."""
    from msgsift.plans.inputs import ratio_predictions
    rows = [(1, "spam", "win win now", "train"), (2, "ham", "hello you", "train"), (3, "spam", "win you now now", "test"),
            (4, "ham", "", "test"), (5, "ham", "unseen hello", "test"), (5, "ham", "hello", "test")]
    df = spark.createDataFrame(rows, "row_id long, label string, text string, split string")
    out = ratio_predictions(df, text=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "text" not in out.columns
    a = {w: math.log(((s + .5) / (3 + .5 * 4)) / ((h + .5) / (2 + .5 * 4))) for w, s, h in
         (("win", 2, 0), ("now", 1, 0), ("hello", 0, 1), ("you", 0, 1))}
    want = {3: a["win"] + a["you"] + 2 * a["now"], 4: 0.0, 5: 2 * a["hello"]}
    got = out.collect()
    assert sorted(r.row_id for r in got) == [3, 4, 5, 5]
    assert all(abs(r.spam_probability - 1 / (1 + math.exp(-want[r.row_id]))) < 1e-8 for r in got)
    assert sorted(r.text for r in ratio_predictions(df).collect()) == ["", "hello", "unseen hello", "win you now now"]


def test_grouped_split_cuts_a_table_of_keys(spark):
    """Attempts look at keys and labels only: the texts are read for them and for the sides; a null text is a group."""
    rows = [(i, "spam" if i % 3 == 0 else "ham", None if i % 40 == 3 else f"msg {i % 40}") for i in range(1, 200)]
    df = spark.createDataFrame(rows, "row_id long, label string, text string")
    sp, seed = S.grouped_split(df)
    once = S.grouped_split_once(df, seed=seed)
    assert sorted(map(tuple, sp.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    assert 0 < once.where("split = 'test'").count() < 199
