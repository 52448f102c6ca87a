"""The pipeline against a brute-force run in plain Python, and its stages on edge rows."""

import re
from hashlib import md5

import corpus_pipeline
import pytest

from msgsift.llm import quality
from msgsift.llm._common import read_table
from tests.conftest import SF
from tests.llm.edge_tables import DOC_SCHEMA, documents, to_spark
from tests.llm.test_free_operators import slow_components, slow_print

WS = " \t\n\x0b\x0c\r"


def slow_lines(docs):
    """Copies of a text count once per host; lines on more than the pipeline's share of a host's different texts go."""
    hosts = {}
    for source, text in {(d["source"], d["text"]) for d in docs}:
        h = hosts.setdefault(source, [0, {}])
        h[0] += 1
        for line in {x.strip(WS) for x in text.split("\n")} - {""}:
            h[1][line] = h[1].get(line, 0) + 1
    out = []
    for d in docs:
        n, lines = hosts[d["source"]]
        text = "\n".join(x for x in d["text"].split("\n")
                         if not (lines.get(x.strip(WS), 0) >= 5 and n >= 5 and lines[x.strip(WS)] / n > corpus_pipeline.BOILERPLATE_RATIO))
        out.append({**d, "text": text, "n_chars": len(text)})
    return out


def slow_near(docs):
    prints = {d["doc_id"]: slow_print(d["text"]) for d in docs}
    groups = slow_components(prints)
    return [d for d in docs if groups[d["doc_id"]] == d["doc_id"]]


def slow_clean(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))

    wins = set()
    for t in items:
        w = words(t)
        wins |= {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    sizes = {len(w) for w in wins}
    return [d for d in docs if not any(tuple(w[i:i + n]) in wins for w in [words(d["text"])] for n in sizes for i in range(len(w) - n + 1))]


def slow_mix(docs):
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"])) for d in docs}
    sources = sorted({d["source"] for d in docs})
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    total = {s: sum(size[d["doc_id"]] for d in docs if d["source"] == s) for s in sources}
    left, open_, target = float(sum(total.values())), set(sources), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * total[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3.0 * total[s]
            left -= target[s]
        open_ -= full
    out = []
    for s in sources:
        before, epochs = 0, int(target[s] // total[s]) if total[s] else 0
        rest = target[s] - epochs * total[s]
        key = {d["doc_id"]: md5(f"42|{d['doc_id']}|{md5(d['text'].encode()).hexdigest()}".encode()).hexdigest() for d in docs if d["source"] == s}
        for i in sorted(key, key=key.get):
            n = size[i]
            times = epochs + (n > 0 and before + n / 2 <= rest)
            before += n
            out += [(i, e) for e in range(1, times + 1)]
    return sorted(out)


def test_run_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = read_table(spark, sf, "documents")
    model = quality.fit(docs, read_table(spark, sf, "labels"))
    rows = [r.asDict() for r in docs.collect()]
    rows = good = [r for r in rows if model.score(r["text"]) >= 0.3]
    rows = slow_lines(rows)
    assert sum(a["text"] != b["text"] for a, b in zip(good, rows, strict=True)) > 10
    rows = slow_near(rows)
    rows = slow_clean(rows, [r.text for r in read_table(spark, sf, "benchmark").collect()])
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == [*docs.columns, "epoch"]
    got = got.collect()
    assert sorted((r.doc_id, r.epoch) for r in got) == slow_mix(rows)
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in rows}
    assert all((r.text, r.n_chars) == text[r.doc_id] for r in got)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_edge_rows(spark, name, stage):
    df = to_spark(spark, documents(), DOC_SCHEMA)
    out = stage(spark, df, SF)
    extra = len(out.columns) - len(df.columns)
    assert out.columns[:len(df.columns)] == df.columns and extra == (name == "source_mixing")
    assert out.count() >= 1
    empty = spark.createDataFrame([], df.schema)
    assert stage(spark, empty, SF).count() == 0


def test_copies_of_a_page_keep_their_lines(spark):
    """Copies that hold a third of a host count as one page: line dedup leaves them, near-dedup keeps one."""
    def lines(i):
        return "\n".join(f"{md5(f'{i} {k} {w}'.encode()).hexdigest()[:6]} own words of page {i}" for k in range(5) for w in range(2))

    pages = [(i, lines(i) + "\nShared footer of the host", "en", "a", 1) for i in range(40)]
    for g, size in ((100, 20), (200, 15)):
        pages += [(g + i, lines(g), "en", "a", 1) for i in range(size)]
    df = spark.createDataFrame(pages, DOC_SCHEMA)
    cut = corpus_pipeline.dedup_lines(spark, df, SF)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert all(texts[i] == lines(i // 100 * 100 if i >= 100 else i) for i in texts)
    kept = {r.doc_id: r.text for r in corpus_pipeline.dedup_near(spark, cut, SF).collect()}
    assert {i: kept.get(i) for i in (100, 200)} == {i: lines(i) for i in (100, 200)}
    assert not any(i % 100 for i in kept if i >= 100)


def test_lines_on_three_to_ten_percent_of_a_host_are_boilerplate(spark):
    """Planted lines on 3, 5 and 10 % of 200 pages go on every page; one on 1.5 % and the pages' own lines stay."""
    planted = {"Three in a hundred.": 6, "Five in a hundred.": 10, "Ten in a hundred.": 20, "A rare line.": 3}
    pages = [(i, "\n".join([f"own start {i}", *(x for x, n in planted.items() if i % (200 // n) == 0 and i // (200 // n) < n), f"own end {i}"]), "en", "a", 1)
             for i in range(200)]
    assert {x: sum(x in p[1].split("\n") for p in pages) for x in planted} == planted
    cut = corpus_pipeline.dedup_lines(spark, spark.createDataFrame(pages, DOC_SCHEMA), SF).collect()
    want = {p[0]: "\n".join(x for x in p[1].split("\n") if x not in planted or x == "A rare line.") for p in pages}
    assert {r.doc_id: r.text for r in cut} == want
    assert all(r.n_chars == len(r.text) for r in cut)


def test_quality_stage_keeps_good_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    kept = corpus_pipeline.quality_classifier(spark, docs, sf).select("doc_id")
    good = labels.where("quality = 1").select("doc_id")
    assert good.join(kept, "doc_id").count() >= 0.97 * good.count()
    bad = labels.where("quality = 0").select("doc_id")
    assert bad.join(kept, "doc_id").count() <= 0.2 * bad.count()


def test_stages_and_constants():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup",
                                                      "benchmark_decontamination", "source_mixing"]
    assert corpus_pipeline.ORACLE_SQL is None
