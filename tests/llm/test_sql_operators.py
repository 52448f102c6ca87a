"""Operators with SQL: against DuckDB on a test table and on edge rows."""

import pytest
from pyspark.sql import functions as F

from msgsift.llm import decontaminate, exact_dedup, line_dedup, mixing
from msgsift.llm.oracle import ORACLES
from msgsift.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.edge_tables import DOC_SCHEMA, benchmark, documents, expected, rows_of, to_spark
from tests.oracle_harness import digest, duck

BENCH_SCHEMA = "item_id long, text string"
RUNS = {
    "op1_line_dedup": lambda d, b: line_dedup.line_report(d),
    "op6_exact_dedup": lambda d, b: exact_dedup.exact_dedup(d),
    "op7_decontamination": lambda d, b: decontaminate.contamination(d, b),
    "op9_mixing": lambda d, b: mixing.mix_report(d),
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert digest(QUERIES[name](spark, SF).toPandas()) == digest(duck(ORACLES[name], SF))


@pytest.mark.parametrize("name", sorted(RUNS))
def test_edge_rows(spark, name):
    docs = documents()
    out = RUNS[name](to_spark(spark, docs, DOC_SCHEMA), to_spark(spark, benchmark(), BENCH_SCHEMA))
    assert rows_of(out.toPandas()) == rows_of(expected(name, docs))


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_tables(spark, name):
    d, b = spark.createDataFrame([], DOC_SCHEMA), spark.createDataFrame([], BENCH_SCHEMA)
    assert RUNS[name](d, b).count() == 0


def test_index_splits_overfull_buckets(spark):
    """A tiny capacity doubles the directory often; results stay the same and buckets hold it."""
    docs = documents()
    df = to_spark(spark, docs, DOC_SCHEMA)
    out = exact_dedup.exact_dedup(df, capacity=2, initial_depth=1)
    assert rows_of(out.toPandas()) == rows_of(expected("op6_exact_dedup", docs))
    _, index = exact_dedup.build_index(df, "doc_id", "text", capacity=2, initial_depth=1)
    assert index.groupBy("depth", "slot").count().agg(F.max("count")).first()[0] <= 2
    assert index.agg(F.max("depth")).first()[0] > 1


def test_an_owner_holds_whole_buckets(spark):
    """Every bucket lies in one file, several files hold buckets, and the buckets of a file are neighbours."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    _, index = exact_dedup.build_index(df, "doc_id", "text", capacity=40, initial_depth=2)
    rows = index.select("depth", "slot", "owner", F.input_file_name().alias("f")).distinct().collect()
    assert len({(r.depth, r.slot) for r in rows}) == len(rows) > 20
    assert len({r.f for r in rows}) > 1
    runs = [r.owner for r in sorted(rows, key=lambda r: r.slot << (63 - r.depth))]
    assert runs == sorted(runs)
    folded = index.agg(F.sum("n")).first()[0]
    assert folded == df.count()


def test_colliding_hashes_are_told_apart_by_bytes(spark, monkeypatch):
    """With a constant digest every text collides; the bytes still decide."""
    docs = documents()
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("00"))
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    out = exact_dedup.exact_dedup(to_spark(spark, docs, DOC_SCHEMA)).drop("text_sha256").toPandas()
    assert rows_of(out) == rows_of(expected("op6_exact_dedup", docs).drop(columns="text_sha256"))


def test_drop_lines_keeps_columns_and_rows(spark):
    df = to_spark(spark, documents(), DOC_SCHEMA)
    out = line_dedup.drop_lines(df, min_pages=2, max_ratio=0.2)
    assert out.columns == df.columns and out.count() == df.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[9] == "body nine one two" and texts[13] == "" and texts[4] is None


def test_drop_contaminated(spark):
    df = to_spark(spark, documents(), DOC_SCHEMA)
    out = decontaminate.drop_contaminated(df, to_spark(spark, benchmark(), BENCH_SCHEMA))
    want = expected("op7_decontamination", documents())
    assert out.columns == df.columns
    assert out.count() == int((~want["contaminated"]).sum())


def test_proximity_finds_shuffled_words(spark):
    docs = spark.createDataFrame([(1, "zz kappa alpha filler beta gamma"), (2, "alpha " + "x " * 50 + "beta gamma kappa"), (3, None)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(9, "alpha beta gamma kappa")], "item_id long, text string")
    got = decontaminate.proximity_matches(docs, bench, span=8).collect()
    assert [(r.doc_id, r.item) for r in got] == [(1, "9")]


def test_mix_repeats_and_limits(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", s, 1) for i, s in enumerate(["a"] * 60 + ["b"] * 6 + ["c"] * 30)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    mix = mixing.mix_documents(df)
    assert mix.columns == [*df.columns, "epoch"]
    assert mix.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    report = mixing.mix_report(df).toPandas()
    taken = mix.groupBy().agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert taken == report["taken"].sum()
    assert (report["taken"] <= 3 * report["size"]).all()
    by = report.groupby("target")["taken"].sum()
    for target, words in by.items():
        assert abs(target - words) <= 7


def test_heavy_rows_are_not_broadcast(spark):
    """Few rows with long arrays weigh too much for the hint; nulls, nested values and no rows are weighed too."""
    from msgsift.llm._common import light_or_shuffled
    rows = [(1, ["x" * 100] * 1000, (1, "a")), (2, None, None)]
    df = spark.createDataFrame(rows, "k long, words array<string>, s struct<n: long, t: string>")
    other = spark.range(10)
    plan = lambda d: other.join(d, other["id"] == d["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(light_or_shuffled(df, max_bytes=120_000))
    assert "strategy=merge" in plan(light_or_shuffled(df, max_bytes=100_000))
    assert "strategy=merge" in plan(light_or_shuffled(df, bound=1))
    assert "strategy=broadcast" in plan(light_or_shuffled(df.where("k > 5"), max_bytes=0))


@pytest.mark.parametrize("name", ["op1_line_dedup", "op7_decontamination"])
def test_shuffled_joins_give_the_same_rows(spark, name, monkeypatch):
    """Whatever is too heavy to broadcast is shuffled: same rows, null keys included."""
    for module in (line_dedup, decontaminate):
        real = module.light_or_shuffled
        monkeypatch.setattr(module, "light_or_shuffled", lambda df, _real=real, **kw: _real(df, **{**kw, "max_bytes": 0}))
    docs = documents()
    out = RUNS[name](to_spark(spark, docs, DOC_SCHEMA), to_spark(spark, benchmark(), BENCH_SCHEMA))
    assert rows_of(out.toPandas()) == rows_of(expected(name, docs))
    assert digest(QUERIES[name](spark, SF).toPandas()) == digest(duck(ORACLES[name], SF))
