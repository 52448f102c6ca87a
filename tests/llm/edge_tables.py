"""Small tables with nulls, ties, repeated rows, empty and long texts, and clashing column names."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from msgsift.llm.oracle import ORACLES

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside; extra columns of these names must pass or be ignored.
CLASHES = ["id", "t", "h", "sha", "host", "digest", "drops", "fp", "u", "v", "src", "key", "n", "pid", "run", "doc", "sig",
           "p", "win", "size", "_boiler_host", "_sim_doc", "_sim_own", "_bad_doc", "_mix_key", "epoch", "score", "before"]


def documents():
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"
    long = " ".join(f"word{i % 977} filler{i % 13}" for i in range(20_000))
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, "  " + base.replace(" ", "\t ") + "\n", "en", "b", 1),
        (4, None, None, None, None), (5, "", "en", "a", 0), (5, "", "en", "a", 0), (6, " \t\n", "en", None, 3), (None, base, "en", "b", 1),
        (None, None, None, "b", None), (7, long, "en", "a", 9), (8, long + " end", "en", "a", 9), (9, "Stop line\nbody nine one two", "en", "a", 1),
        (10, "Stop line\nbody ten three four", "en", "a", 1), (11, "Stop line \nbody eleven five", "en", "a", 1),
        (12, "other start\nStop line\nunique twelve", "en", "a", 1), (13, "Stop line", "en", "a", 1), (14, "ONE", "en", "c", 1), (15, "one", "en", "c", 1),
        (16, "Café – naïve   nbsp words", "fr", "c", 1), (17, base.upper() + " tail", "en", "d", 1), (18, "x" * 5000, "en", "d", 1),
        (2, "another text under the same id", "en", "d", 1),
    ]
    return pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"})


def benchmark():
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"), (2, "body nine one two"), (3, None), (4, ""),
            (5, "ONE"), (6, "body nine one two"), (None, "unique twelve"), (7, "gamma delta epsilon zeta eta theta iota kappa lamda mu nu"),
            (2, "café naïve"), (8, "word1 filler1 word2 filler2 word3 filler3 word4 filler4 word5 filler5 word6")]
    return pd.DataFrame(rows, columns=["item_id", "text"]).astype({"item_id": "Int64"})


def to_spark(spark, table, schema, clashes=True):
    rows = [tuple(None if pd.isna(x) else x.item() if hasattr(x, "item") else x for x in r) for r in table.itertuples(index=False)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns}) if clashes else df


def expected(name, docs, bench=None):
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("benchmark", benchmark() if bench is None else bench)
    return con.execute(ORACLES[name]).fetchdf()


def rows_of(pdf, floats=9):
    def norm(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if hasattr(x, "item"):
            return norm(x.item())
        return round(x, floats) if isinstance(x, float) else x

    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False)]
    return cols, sorted((tuple(float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r) for r in out), key=repr)
