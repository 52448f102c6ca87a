"""Hard negatives, token counts and spelling variants against brute force and on edge rows."""

import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from msgsift.llm import hard_negatives, spelling, token_counts
from msgsift.llm.oracle import ORACLES
from msgsift.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.edge_tables import DOC_SCHEMA, documents, rows_of, to_spark

BPE = public_tokenizers.path("byte_bpe_50k.json")
VEC_SCHEMA = "vec_id long, embedding array<float>, label int"


# ---- op11 -----------------------------------------------------------------------------------

def mined(df):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, moved)


def mined_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r) for r in rows])
    return con.execute(ORACLES["op11_hard_negatives"]).fetchdf()


def vectors(n=700, dims=5, seed=3, scale=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * scale
    x[::9] = x[3]  # one very common vector, so that scores tie
    x[100:300] = np.round(x[100:300], 1)
    rows = [(int(i * 4), [float(np.float32(c)) for c in x[i]], int(rng.integers(3))) for i in range(n)]
    rows += [(9001, None, 1), (9100, [0.0] * dims, None), (None, [1.0] * dims, 1), (9200, [float("nan")] + [1.0] * (dims - 1), 1),
             (9300, [float("inf")] + [0.5] * (dims - 1), 2), (9400, [None] + [0.5] * (dims - 1), 2), (9500, [0.0] * dims, 0),
             (9600, [0.3] * dims, 8), (9700, [-1.0] * dims, 1)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"SLICE_ROWS": 50, "GROUP_ROWS": 3, "STEP": 7, "MAX_CLUSTERS": 5}])
def test_hard_negatives_equal_sql(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors()
    df = spark.createDataFrame(rows, VEC_SCHEMA).withColumns({c: F.lit("x") for c in ("q", "g", "s", "cluster", "score", "wants", "v")})
    want = mined_sql(rows)
    assert len(want) > 300 and rows_of(mined(df).toPandas()) == rows_of(want)


def test_hard_negatives_large_components_are_exact(spark):
    """Scores beyond 2^53 take the integer path."""
    rows = [(i * 4, [float(3_000_000 + (i * 37) % 1000), float(i % 50)], i % 2) for i in range(120)]
    want = []
    q = {i: [int(256 * np.float32(c)) for c in v] for i, v, _ in rows}
    label = {i: (lab + 1) % 10 if i % 7 == 0 else lab for i, _, lab in rows}
    for a in [i for i in q if i % 100 == 0]:
        score = {i: sum(x * y for x, y in zip(q[a], q[i], strict=True)) for i in q if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if label[i] == label[a]][:5]:
            fits = [i for i in order if label[i] != label[a] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:10]
            want += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(fits)]
    got = mined(spark.createDataFrame(rows, VEC_SCHEMA)).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_hard_negatives_repeated_ids_short_vectors_and_empty(spark):
    base = [r for r in vectors() if r[0] is not None][:200]
    twice = base + base[:50] + [(base[5][0], base[9][1], 99)]  # the smallest label of an id takes part
    df = spark.createDataFrame(twice, VEC_SCHEMA)
    assert rows_of(mined(df).toPandas()) == rows_of(mined_sql(base))
    short = [(i, v[:3] if i % 8 == 0 else v, lab) for i, v, lab in base]
    padded = [(i, v + [0.0] * (5 - len(v)), lab) for i, v, lab in short]
    assert rows_of(mined(spark.createDataFrame(short, VEC_SCHEMA)).toPandas()) == rows_of(mined_sql(padded))
    assert mined(spark.createDataFrame([], VEC_SCHEMA)).count() == 0
    assert mined(spark.createDataFrame([(100, [], 1), (200, [], 1), (300, [], 2)], VEC_SCHEMA)).count() == 2


def test_walk_stops_early_and_stays_exact():
    """On directed data most of a list is never scored."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 16)) * 200
    rows = np.floor(centres[rng.integers(8, size=4000)] + rng.normal(size=(4000, 16)) * 3).astype(np.int64)
    import pyarrow as pa
    part = hard_negatives.Slice(pa.table({"vec_id": np.arange(4000), "label": np.zeros(4000, np.int64),
                                          "q": pa.array(rows.tolist(), pa.list_(pa.int64()))}), 16)
    units, norms = hard_negatives.directions(rows[:20])
    c = hard_negatives.fit_centroids(rows[:20], 1)
    c = units[:1]
    near = np.flatnonzero(units @ c[0] > 0.99)
    order, bounds = part.list_of(c[0], float(hard_negatives.angles(units[near], c).max()))
    scored = []
    real = part.labels
    part.labels = type("Seen", (), {"__getitem__": lambda self, i: (scored.append(np.size(i)), real[i])[1]})()
    low, high = np.full(len(near), -2**62), np.full(len(near), 2**62)
    got = hard_negatives.walk(part, order, bounds, rows[near], norms[near], True, near, np.zeros(len(near), np.int64), low, high, 5)
    for i, found in zip(near, got, strict=True):
        s = rows @ rows[i]
        s[i] = -2**62
        assert found == sorted((int(-x), j) for j, x in enumerate(s))[:5]
    assert sum(scored) < 2000


# ---- op12 -----------------------------------------------------------------------------------

def plain_counts(texts, path=BPE):
    lib = Tokenizer.from_file(path)
    return [len(lib.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_token_counts_of_the_query(spark):
    got = QUERIES["op12_token_counts"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    want = pd.DataFrame({"doc_id": docs["doc_id"], "n_bytes": [len((t or "").encode()) for t in docs["text"]], "n_tokens": plain_counts(docs["text"])})
    want["over_limit"] = want["n_tokens"] > 512
    assert rows_of(got) == rows_of(want) and 0 < want["over_limit"].sum() < len(want)


def test_token_counts_edge_rows(spark):
    docs = documents()
    extra = pd.DataFrame([(50, "a<|endoftext|>b  <|endoftext|> \n\n x", "", "", 0), (51, "tabs\t \t and spaces   \x1c end  ", "", "", 0),
                          (52, "漢字かな交じり文 " * 500, "", "", 0), (53, "' 's 'S don't 12 3.4 😀 é", "", "", 0)], columns=docs.columns)
    docs = pd.concat([docs, extra.astype(docs.dtypes)])
    got = token_counts.token_counts(to_spark(spark, docs, DOC_SCHEMA), BPE).toPandas()
    texts = [None if pd.isna(t) else t for t in docs["text"]]
    want = pd.DataFrame({"doc_id": docs["doc_id"], "n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": plain_counts(texts)})
    want["over_limit"] = want["n_tokens"] > 512
    assert rows_of(got) == rows_of(want)
    assert token_counts.token_counts(spark.createDataFrame([], DOC_SCHEMA), BPE).count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_cache_encodes_only_distinct_misses(spark, tmpdir_path, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(token_counts, "BROADCAST_ROWS", 1)
    cache = os.path.join(tmpdir_path, "cache")
    first = spark.createDataFrame([(1, "one text"), (2, "one text"), (3, "two"), (4, None), (4, None), (5, "")], "doc_id long, text string")
    token_counts.token_counts(first, BPE, cache).collect()
    stored = spark.read.parquet(cache)
    assert stored.select("digest").distinct().count() == 3
    assert stored.count() == 3
    before = {r.digest: r for r in stored.collect()}
    more = first.unionByName(spark.createDataFrame([(6, "three"), (7, "one text")], "doc_id long, text string"))
    got = {(r.doc_id, r.n_tokens) for r in token_counts.token_counts(more, BPE, cache).collect()}
    assert got == {(1, 2), (2, 2), (3, 1), (4, 0), (5, 0), (6, 1), (7, 2)}
    added = [r for r in spark.read.parquet(cache).collect() if bytes(r.digest) not in {bytes(k) for k in before}]
    assert len(added) == 1
    # A cached count is used as it is stored: nothing is encoded again.
    files = len(os.listdir(cache))
    token_counts.token_counts(more, BPE, cache).collect()
    assert len(os.listdir(cache)) == files


def test_cache_keeps_versions_apart(spark, tmpdir_path):
    cache = os.path.join(tmpdir_path, "cache")
    df = spark.createDataFrame([(1, "Hello  WORLD"), (2, "hello world")], "doc_id long, text string")
    token_counts.token_counts(df, BPE, cache).collect()
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, path, cache).collect()}
        counter = token_counts.Counter(token_counts.Tokenizer(path))
        assert got == {1: counter.encode_sizes(["Hello  WORLD"])[0], 2: counter.encode_sizes(["hello world"])[0]}
    rows = spark.read.parquet(cache).groupBy("version").count().collect()
    # The lower-casing tokenizer normalises both texts to one content.
    assert sorted(r["count"] for r in rows) == [1, 2, 2]


def test_pieces_add_up_to_the_whole_text():
    counter = token_counts.Counter(token_counts.Tokenizer(BPE))
    assert counter.by_piece
    parts = [" ", "  ", "\n", "\t", "\x1c", "᠎", " ", "a", "B", "é", "漢", "1", "!", "'s", "'", "<|endoftext|>", "<|endo", "　", "​", "́", "😀"]
    rng = np.random.default_rng(5)
    texts = ["".join(parts[i] for i in rng.integers(len(parts), size=rng.integers(14))) for _ in range(4000)]
    assert [counter.count(t) for t in texts] == counter.encode_sizes(texts)


# ---- op13 -----------------------------------------------------------------------------------

def slow_variants(rows, min_chars=6, min_count=5, factor=5, noise=199):
    """Deletion neighbourhoods on plain dictionaries: nothing shared with the operator."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % noise == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1:]
            n[w] += 1
    vocab = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    letters = sorted({c for w in vocab for c in w})
    out = {}
    for w, c in vocab.items():
        near = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in letters}
        near |= {w[:i] + x + w[i + 1:] for i in range(len(w)) for x in letters}
        near = sorted((x for x in near if x in vocab and x != w), key=lambda x: (-vocab[x], x))
        form = near[0] if near and vocab[near[0]] >= factor * c else None
        out[w] = (form, c, len(near), vocab[form] if form else None)
    table = []
    for w, (form, c, k, fn) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        table.append((w, form, root, c, k, fn))
    return sorted(table)


def as_rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("blocks", [{}, {"block_words": 50, "slice_words": 20}])
def test_spelling_variants_of_the_table(spark, blocks):
    """Near words come up in earnest when rarer and shorter words count too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 4 = 0")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = as_rows(spelling.variants(docs, min_chars=4, min_count=2, noise=5, **blocks))
    assert got == slow_variants(rows, 4, 2, noise=5)
    assert sum(r[1] is not None for r in got) > 50 and sum(r[4] > 1 for r in got) > 100


def test_spelling_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert as_rows(QUERIES["op13_spelling_variants"](spark, SF)) == slow_variants([(r.doc_id, r.text) for r in docs])


def test_spelling_chains_ties_and_edges(spark):
    words = {"colour": 700, "colours": 130, "coloura": 130, "colouras": 20, "colourass": 5, "colou": 900, "Colour": 20, "ÀÉabcd": 9, "ÀÉabce": 9, "àéabcd": 60,
             "xolours": 5, "olours": 5, "colouurs": 6, "y" * 3000: 6, "y" * 3001: 40, "z" * 6: 5, "z" * 7: 5, "z" * 8: 25}
    rows = [(None if i % 3 else 7, f"{w}, {w}") for i, (w, n) in enumerate(words.items()) for _ in range(n // 2)]
    rows += [(8, w) for w, n in words.items() if n % 2] + [(1, None), (None, None), (2, ""), (3, "12 34 \t"), (3, "12 34 \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "len", "id", "t", "form", "root")})
    got = as_rows(spelling.variants(df))
    assert got == slow_variants(rows)
    by = {r[0]: r for r in got}
    assert by["colourass"][2] == "colour" or by["colourass"][1] is None
    assert as_rows(spelling.variants(spark.createDataFrame([], DOC_SCHEMA))) == []


def test_spelling_random_words(spark):
    rng = np.random.default_rng(2)
    vocab = ["".join(rng.choice(list("abc"), size=rng.integers(1, 9))) for _ in range(400)]
    rows = [(int(i), " ".join(rng.choice(vocab, size=30))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = as_rows(spelling.variants(df, min_chars=1, min_count=1, factor=2, block_words=70, slice_words=30))
    assert got == slow_variants(rows, 1, 1, 2)
