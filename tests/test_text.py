import re
import unicodedata

from pyspark.sql import functions as F

from msgsift.functions import make_ngrams, normalize_label, strip_accents, strip_ws, tokenize, word_analyzer


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


def test_tokenize_traps(spark):
    text = "It's o'b's lovers' 123 150p Café  café"
    t = _one(spark, tokenize, text)
    expected = [x for x in re.findall(r"[a-z0-9]+(?:'[a-z0-9]+)?", text.strip().lower()) if not x.isdigit()]
    assert t == expected == ["it's", "o'b", "s", "lovers", "150p", "caf", "caf"]
    assert _one(spark, lambda c: tokenize(c, lowercase=False), "Hello World abc") == ["ello", "orld", "abc"]
    assert _one(spark, tokenize, None) == []
    assert _one(spark, lambda c: tokenize(c, filter_numeric_only=False), "a 12") == ["a", "12"]
    assert _one(spark, lambda c: tokenize(c, remove_stopwords=True, min_token_length=2), "I am the cat ox") == ["cat", "ox"]


def test_strip_is_unicode(spark):
    assert _one(spark, strip_ws, "\t  hi there\n　") == "hi there"


def test_ngrams(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b", "c"],), ([],)], "t array<string>")
    out = [r[0] for r in df.select(make_ngrams(F.col("t"), 2)).collect()]
    assert out == [[], ["a b", "b c"], []]


def test_normalize_label(spark):
    vals = ["0", "1", "TRUE", " False ", "HAM", "spam", "maybe", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = [r[0] for r in df.select(normalize_label(F.col("v"))).collect()]
    assert out == ["ham", "spam", "spam", "ham", "ham", "spam", None, None, None]


def _py_words(s):
    s = "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))
    return re.findall(r"(?u)\b\w[\w']*\b", s)


def test_word_analyzer_matches_python_regex(spark):
    texts = ["Café crème brûlée!", "lovers' o'b's it's", "snake_case x''y 'quoted'",
             "Straße æon øl naïve", "Здравствуй мир 123abc"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(word_analyzer(F.col("v"))).collect()]
    assert got == [_py_words(t) for t in texts]


def _assigned(lo, hi):
    return [c for c in range(lo, hi) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]


def test_strip_accents_needs_no_python_worker(spark):
    """Every assigned character alone, as unicodedata has it, and long mixed texts; the plan stays in the JVM."""
    rows = [(c, f"a{chr(c)}b") for c in _assigned(0, 0x110000)] + [(-1, None), (-2, ""), (-3, "e\u0301\u0323x \ufb01 " * 5000)]
    df = spark.createDataFrame(rows, "c long, v string").select("c", "v", strip_accents(F.col("v")).alias("r"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        want = None if r.v is None else "".join(x for x in unicodedata.normalize("NFKD", r.v) if not unicodedata.combining(x))
        assert r.r == want, hex(r.c)


def test_strip_removes_what_python_strips(spark):
    rows = [(c, f"{chr(c)} a{chr(c)}b {chr(c)}\n") for c in _assigned(0, 0x3100)] + [(-1, " \t\u3000"), (-2, None)]
    for r in spark.createDataFrame(rows, "c long, v string").select("c", "v", strip_ws("v").alias("r")).collect():
        assert r.r == (None if r.v is None else r.v.strip()), hex(r.c)
