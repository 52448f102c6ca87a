import math

import pytest

from msgsift.operators import corpus as C


def _msgs(spark, rows):
    return C.with_tokens(spark.createDataFrame(rows, "row_id long, label string, text string"))


def test_frequent_words_first_seen_ties(spark):
    m = _msgs(spark, [(1, "ham", "b a"), (2, "spam", "a b c"), (3, "ham", "")])
    fw = C.frequent_words(m, 3).orderBy("rank").collect()
    assert [(r.token, r["count"], r.document_count) for r in fw] == [("b", 2, 2), ("a", 2, 2), ("c", 1, 1)]
    assert fw[0].document_percentage == round(2 / 3 * 100, 4)


def test_term_score_golden(spark):
    """Published figures: 113 of 16,784 spam tokens, none of 68,621 ham tokens, 8,313 words, 0.5 -> 6.6707."""
    spam = " ".join(["claim"] * 113 + [_word(i % 1000) for i in range(16_784 - 113)])
    ham = " ".join(_word(1000 + i % (8313 - 1001)) for i in range(68_621))
    top = C.typical_terms(C.term_scores(_msgs(spark, [(1, "spam", spam), (2, "ham", ham)])), 1).first()
    assert top.token == "claim" and (top.spam_count, top.ham_count) == (113, 0)
    assert round(top.log_rate_ratio_spam_vs_ham, 4) == 6.6707


def _word(i):
    """Distinct words of letters only."""
    return "w" + "".join("abcdefghij"[int(c)] for c in str(i))


def test_errors_for_corpora_without_tokens(spark):
    with pytest.raises(C.TextAnalysisError):
        C.frequent_words(_msgs(spark, [(1, "ham", "123"), (2, "spam", "")]))
    with pytest.raises(C.TextAnalysisError, match="spam"):
        C.term_scores(_msgs(spark, [(1, "ham", "some words"), (2, "spam", "99")]))
    with pytest.raises(C.TextAnalysisError):
        C.report_tables(_msgs(spark, [(1, "ham", "some words"), (2, "spam", "others")]), min_count=5)


def test_term_scores_full_outer_alignment(spark):
    m = _msgs(spark, [(1, "ham", "x y y"), (2, "spam", "z x")])
    sc = {r.token: r for r in C.term_scores(m).collect()}
    assert set(sc) == {"x", "y", "z"}
    assert sc["y"].spam_count == 0 and sc["z"].ham_count == 0
    t_s, t_h, v = 2, 3, 3
    exp = math.log(((1 + .5) / (t_s + .5 * v)) / ((2 + .5) / (t_h + .5 * v)))
    assert abs(sc["y"].log_rate_ratio_ham_vs_spam - (-math.log(((0 + .5) / (t_s + .5 * v)) / ((2 + .5) / (t_h + .5 * v))))) < 1e-12
    assert abs(sc["x"].log_rate_ratio_spam_vs_ham - math.log(((1 + .5) / (t_s + .5 * v)) / ((1 + .5) / (t_h + .5 * v)))) < 1e-12
    assert exp != 0


def test_ngrams_single_token_message(spark):
    m = _msgs(spark, [(1, "ham", "solo"), (2, "ham", "a b a b")])
    ng = C.frequent_ngrams(m, sizes=(2, 3), top_n=5).collect()
    bi = {r.ngram: r["count"] for r in ng if r.n == 2}
    assert bi == {"a b": 2, "b a": 1}
    assert all(r.document_percentage == 50.0 for r in ng)


def test_merged_sketches_are_near_the_exact_counts(spark, tmpdir_path):
    """Every union of stored sketches, against exact distinct counts; equal where all tokens fit."""
    from itertools import combinations
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    msgs = C.with_tokens(docs.selectExpr("doc_id AS row_id", "lang", "source AS label", "text"))
    C.token_sketches(msgs, ["lang", "label"]).write.parquet(f"{tmpdir_path}/s")
    stored = spark.read.parquet(f"{tmpdir_path}/s").cache()
    words = {}
    for r in msgs.select("lang", "tokens").collect():
        words.setdefault(r.lang, set()).update(r.tokens)
    for n in range(1, len(words) + 1):
        for langs in combinations(sorted(words), n):
            got = C.merged_unique_tokens(stored.where(stored.lang.isin(*langs))).first()
            exact = len(set().union(*[words[x] for x in langs]))
            assert abs(got.unique_tokens / exact - 1) < 0.05
    total = C.merged_unique_tokens(stored).first()
    assert total.messages == docs.count() and total.tokens == sum(len(r.tokens) for r in msgs.select("tokens").collect())
    few = C.token_sketches(_msgs(spark, [(1, "ham", "a b a"), (2, None, "b c"), (3, "spam", "")]), ["label"])
    assert {r.label: r.unique_tokens for r in C.merged_unique_tokens(few, ["label"]).collect()} == {"ham": 2, None: 2, "spam": 0}
    assert C.merged_unique_tokens(few).first().unique_tokens == 3


@pytest.mark.parametrize("buckets", [None, 7])
def test_ngrams_counted_by_hash_equal_a_plain_count(spark, monkeypatch, buckets):
    """Also with hashes that many n-grams share, repeated and null ids and ties in the last place."""
    if buckets:
        monkeypatch.setattr(C, "_ngram_hash", lambda gram: C.F.abs(C.F.xxhash64(gram)) % buckets)
    rows = [(None if i == 5 else i % 17, "ham", " ".join(f"w{(i * j * j + j) % 11}x" for j in range(i % 9))) for i in range(40)]
    m = _msgs(spark, rows)
    for least in (1, 3):
        got = C.frequent_ngrams(m, sizes=(2, 3), top_n=6, min_count=least).collect()
        for n in (2, 3):
            count, docs, first = {}, {}, {}
            for row, _, text in rows:
                t = text.split()
                grams = [" ".join(t[k:k + n]) for k in range(len(t) - n + 1)]
                for g in grams:
                    count[g] = count.get(g, 0) + 1
                for g in set(grams):
                    docs[g] = docs.get(g, 0) + (row is not None)
                    if row is not None:
                        first[g] = min(first.get(g, 99), row)
            best = sorted((c for c in count.values() if c >= least), reverse=True)[:6]
            mine = sorted((r for r in got if r.n == n), key=lambda r: r["rank"])
            assert [r["count"] for r in mine] == best and len({r.ngram for r in mine}) == len(best)
            assert all((r["count"], r.document_count) == (count[r.ngram], docs[r.ngram]) for r in mine)
            keys = [(-r["count"], first.get(r.ngram, -1)) for r in mine]
            assert keys == sorted((-c, first.get(g, -1)) for g, c in count.items() if c >= least)[:6]


def test_ngrams_are_shuffled_as_numbers(spark, tmp_path):
    """The pass over all n-grams groups by a hash, and the tokens come from a table."""
    m = _msgs(spark, [(1, "ham", "a b a b"), (2, "ham", "b a")])
    stats = C._ngram_candidates(m, (2, 3), 5, 1, "tokens")
    assert {f.dataType.typeName() for f in stats.schema if f.name in ("n", "h", "count", "row")} <= {"integer", "long"}
    plan = C.frequent_ngrams(m)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_report_tables_read_stored_tokens(spark):
    m = _msgs(spark, [(1, "ham", "some words some"), (2, "spam", "other words here")])
    tables = C.report_tables(m)
    for name, df in tables.items():
        assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString(), name
    assert {r.ngram for r in tables["trigrams"].collect()} == {"some words some", "other words here"}
