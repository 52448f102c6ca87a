"""Operators without SQL: against brute force, planted cases and held-out rows."""

import itertools
import re
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from msgsift.llm import (
    html_extract,
    license_scan,
    quality,
    simhash,
    substring_dedup,
    toxicity,
)
from msgsift.llm._common import read_table
from msgsift.llm.components import components
from msgsift.llm.html_blocks import leaf_blocks
from msgsift.llm.license_templates import TEMPLATES
from tests.conftest import SF
from tests.llm.edge_tables import DOC_SCHEMA, documents, to_spark

# --- SimHash -----------------------------------------------------------------------------


def slow_print(text, shingle=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, radius=4):
    """doc_id -> smallest id reachable over links of at most ``radius`` bits (all pairs)."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


@pytest.mark.parametrize("limit", [4096, 2])
def test_simhash_equals_all_pairs(spark, limit):
    docs = read_table(spark, SF, "documents")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.report(docs, bucket_limit=limit).collect()}
    prints = {r.doc_id: slow_print(r.text) for r in docs.collect()}
    groups = slow_components(prints)
    assert got == {i: (f"{p:016x}", groups[i]) for i, p in prints.items()}


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair(radius):
    masks = simhash.masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = np.random.default_rng(0)
    pairs = itertools.chain(itertools.combinations(range(64), min(radius, 2)),
                            (rng.choice(64, radius, replace=False) for _ in range(3000)))
    for flips in pairs:
        diff = sum(1 << int(i) for i in flips)
        assert any(not diff & m for m in masks)


@pytest.mark.parametrize("radius", [3, 4])
@pytest.mark.parametrize("limit", [4096, 1])
def test_links_have_the_components_of_all_pairs(spark, radius, limit):
    """Chains of flips in a dense neighbourhood, through both ways of linking a bucket."""
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(0, 2**63, 4)]
    prints = set(base)
    for _ in range(150):
        x = base[int(rng.integers(4))] if rng.random() < 0.5 else sorted(prints)[int(rng.integers(len(prints)))]
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.root for r in components(simhash.link(df, radius, limit)).collect()}
    want = slow_components({p: p & (2**64 - 1) for p in signed}, radius)
    groups = {}
    for p, r in want.items():
        groups.setdefault(r, set()).add(p)
    got = {}
    for p in signed:
        got.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_simhash_edge_rows(spark):
    df = to_spark(spark, documents(), DOC_SCHEMA)
    rows = simhash.report(df).collect()
    assert len(rows) == df.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.fingerprint for i in (4, 5, 6) for r in by[i]} == {"0" * 16}
    assert {r.component_id for i in (4, 5, 6) for r in by[i]} == {4}
    assert {r.component_id for r in by[None]} == {1, 4}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len({r.component_id for r in rows})
    assert simhash.report(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 150], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 if i <= 150 else 151 for i in range(n + 1)}


# --- Substring dedup ---------------------------------------------------------------------


def slow_units(text):
    """[(start, end, words)] read character by character: sentences of five or more words, runs of shorter ones."""
    out = []
    for line_at, line in [(m.start(), m.group()) for m in re.finditer(r"[^\n]+", text or "")]:
        sentences, i = [], 0
        while i < len(line):
            if line[i].isspace():
                i += 1
                continue
            j = i
            while j < len(line):
                if line[j] in ".!?":
                    while j + 1 < len(line) and line[j + 1] in ".!?":
                        j += 1
                    if j + 1 == len(line) or line[j + 1].isspace():
                        break
                j += 1
            end = min(j + 1, len(line))
            sentences.append((i, end, line[i:end].split()))
            i = end
        units = []
        for x, y, words in sentences:
            if units and len(words) < 5 and units[-1][3]:
                units[-1] = (units[-1][0], y, units[-1][2] + words, True)
            else:
                units.append((x, y, words, len(words) < 5))
        out += [(line_at + x, line_at + y, [w.lower() for w in words]) for x, y, words, _ in units]
    return out


def slow_spans(rows, min_words):
    """Spans by a dictionary over all units in rank order, their ends by comparing the words beside them."""
    first, per, units = {}, [], {}
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for doc, sig, text in sorted(set(rows), key=key):
        units[doc, sig] = mine = slow_units(text)
        again = []
        for k, u in enumerate(mine):
            home = first.setdefault(" ".join(u[2]), (doc, sig, k))
            if home != (doc, sig, k):
                again.append((k, home))
        runs = []
        for k, home in again:
            if runs and runs[-1][-1][0] == k - 1:
                runs[-1].append((k, home))
            else:
                runs.append([(k, home)])
        spans = []
        for run in runs:
            (k, (kd, ks, kk)), (z, (zd, zs, zk)) = run[0], run[-1]
            n, start, end = sum(len(mine[i][2]) for i, _ in run), mine[k][0], mine[z][1]
            left, other = (mine[k - 1] if k else None), (units[kd, ks][kk - 1] if kk else None)
            if left and other:
                same = 0
                while same < min(len(left[2]), len(other[2])) and left[2][-1 - same] == other[2][-1 - same]:
                    same += 1
                if same:
                    piece = text[left[0]:start]
                    start = left[0] + [m.start() for m in re.finditer(r"\S+", piece)][-same]
                n += same
            right = mine[z + 1] if z + 1 < len(mine) else None
            other = units[zd, zs][zk + 1] if zk + 1 < len(units[zd, zs]) else None
            if right and other:
                same = 0
                while same < min(len(right[2]), len(other[2])) and right[2][same] == other[2][same]:
                    same += 1
                if same:
                    end += [m.end() for m in re.finditer(r"\S+", text[end:right[1]])][same - 1]
                n += same
            if n >= min_words:
                spans.append((max([start, *[s[2] for s in spans]]), doc, end, n))
        per += [(doc, s, e, n) for s, _, e, n in spans]
    return sorted(per, key=repr)


@pytest.mark.parametrize("sf,min_words", [(SF, 3), (SF, 25), ("/root/testdata/sf0.01", substring_dedup.MIN_WORDS)])
def test_substring_spans_equal_brute_force(spark, sf, min_words):
    docs = read_table(spark, sf, "documents")
    rows = [(r.doc_id, r.s, r.text) for r in docs.select("doc_id", F.xxhash64("text").alias("s"), "text").collect()]
    got = [(r.doc_id, r.start, r.end, r.n_words) for r in substring_dedup.report(docs, min_words=min_words).collect()]
    assert len(got) > 5 and sorted(got, key=repr) == slow_spans(rows, min_words)


def test_planted_passage_is_cut_and_offsets_kept(spark):
    passage = " ".join(f"Sentence number {i} of the planted passage has these words." for i in range(6))
    texts = [f"First own line about apples and pears.\n{passage}\nEnd one.", f"Different intro words stand right here. {passage} And a tail of its own follows.",
             "A clean document without any of that content at all."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = substring_dedup.report(df).collect()
    assert [(r.doc_id, r.keep_ids) for r in spans] == [(1, [0])]
    assert texts[1][spans[0].start:spans[0].end] == passage
    assert texts[1][spans[0].start:spans[0].end] in passage and spans[0].n_words >= 50
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(df).collect()}
    assert out[0].text == texts[0] and out[2].text == texts[2]
    assert "planted" not in out[1].text
    assert "".join(texts[1][p.start:p.end] for p in out[1].kept_offsets) == out[1].text


@pytest.mark.parametrize("n_words", [50, 65, 80])
def test_short_passage_pasted_mid_sentence_is_cut(spark, n_words):
    """Passages of 50 to 80 words that begin and end inside sentences and run over two lines go as a whole."""
    inner, ends = (10, (n_words - 20) // 2) if n_words == 50 else (11, (n_words - 22) // 2)
    first, second = (" ".join(f"{w}{i}" for i in range(inner - 1)) + f" {w}end." for w in ("one", "two"))
    head, tail = (" ".join(f"{w}{i}" for i in range(ends)) for w in ("head", "tail"))
    passage = f"{head}. {first}\n{second} {tail}"
    assert len(passage.split()) == n_words - n_words % 2
    texts = [f"{own} own opening words of {own} {passage} {own} ends it here." for own in ("pear", "plum")]
    df = spark.createDataFrame([*enumerate(texts), (2, "A clean document of other words.")], "doc_id long, text string")
    spans = substring_dedup.report(df).collect()
    assert [(r.doc_id, r.keep_ids, texts[1][r.start:r.end], r.n_words, r.n_units) for r in spans] == [(1, [0], passage, len(passage.split()), 2)]
    out = {r.doc_id: r.text for r in substring_dedup.remove_repeats(df).collect()}
    assert out[0] == texts[0] and first not in out[1] and second not in out[1]


def test_sentences_without_spaces_are_units(spark):
    shared = "这是一句没有空格的句子内容很长。"
    texts = [f"第一篇文章自己的开头文字在这里。{shared}短。", f"另外一篇完全不同的开头文字在此。{shared}"]
    spans = substring_dedup.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), min_words=5).collect()
    assert [(r.doc_id, texts[1][r.start:r.end]) for r in spans] == [(1, shared)]


def test_substring_edge_rows(spark):
    df = to_spark(spark, documents(), DOC_SCHEMA)
    out = substring_dedup.remove_repeats(df, min_words=10)
    assert out.columns == [*df.columns, "kept_offsets"] and out.count() == df.count()
    spans = substring_dedup.report(df, min_words=10).collect()
    assert {r.doc_id for r in spans} >= {2, 3, None}
    assert substring_dedup.report(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


# --- Classifiers -------------------------------------------------------------------------


def auc(y, s):
    rank = np.argsort(np.argsort(s)) + 1.0
    p = y.sum()
    return (rank[y > 0].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


@pytest.fixture(scope="module")
def bigger():
    return "/root/testdata/sf0.1"


def test_quality_on_held_out_rows(spark, bigger):
    docs, labels = read_table(spark, bigger, "documents"), read_table(spark, bigger, "labels")
    model = quality.fit(docs, labels, max_rows=3000)
    got = quality.scored(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    y = got["quality"].to_numpy()
    assert auc(y, got["score"].to_numpy()) > 0.99
    assert got["predicted"][y == 1].mean() > 0.99 and got["predicted"][y == 0].mean() < 0.1
    assert all(crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"])


def test_toxicity_on_held_out_rows(spark, bigger):
    docs, labels = read_table(spark, bigger, "documents"), read_table(spark, bigger, "labels")
    model = toxicity.fit(docs, labels, max_rows=4000)
    got = toxicity.scored(docs, model).join(labels.withColumnRenamed("toxic", "y"), "doc_id").where("held_out").toPandas()
    y = got["y"].to_numpy()
    assert auc(y, got["severity"].to_numpy()) > 0.97
    assert got["toxic"][y == 1].mean() > 0.88 and got["toxic"][y == 0].mean() < 0.03
    assert np.all(np.diff(model.theta) > 0)


def test_dual_coordinate_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    cols = np.arange(5)
    w, b = quality.dual_coordinate_descent([cols] * 60, lambda i: x[i], y, 5, np.full(60, 1.0), epochs=3000, tol=1e-10)

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v[:5] + v[5])).sum()

    best = loss(np.append(w, b))
    for _ in range(300):
        assert loss(np.append(w, b) + rng.normal(scale=0.02, size=6)) >= best - 1e-6


def test_ordinal_gradient_recovers_order():
    rng = np.random.default_rng(2)
    n, size = 600, 3
    x = rng.poisson(1.0, (n, size)).astype(float)
    eta = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=n)
    grades = np.digitize(eta, [0.5, 2.0, 4.0])
    indptr = np.arange(n + 1) * size
    w, theta = toxicity.fit_ordinal(indptr, np.tile(np.arange(size), n), x.ravel(), grades, size, np.ones(n), l2=0.01, rounds=600)
    assert abs(w[0] - 2) < 0.4 and abs(w[1] + 1) < 0.4 and abs(w[2]) < 0.3
    assert np.allclose(theta, [0.5, 2.0, 4.0], atol=0.5)


def test_classifier_edges(spark):
    docs, empty = to_spark(spark, documents(), DOC_SCHEMA), spark.createDataFrame([], DOC_SCHEMA)
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 19)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        q = quality.scored(docs, quality.fit(docs, labels)).toPandas()
        t = toxicity.scored(docs, toxicity.fit(docs, labels)).toPandas()
        assert len(q) == len(t) == docs.count()
        assert q["score"].between(0, 1).all() and t["severity"].between(0, 3).all()
    assert quality.scored(empty, quality.fit(empty, none)).count() == 0
    assert toxicity.scored(empty, toxicity.fit(empty, none)).count() == 0


# --- HTML ------------------------------------------------------------------------------------


def test_blocks_of_untidy_html():
    html = ("<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x='</p>';</script></head><body><p>One <b>bold<p>Two &amp; three<br>four"
            "<ul><li>a<li>b</ul><!-- <p>no</p> --><div class=\"x\">5 &lt; 6</div><textarea>t</textarea>tail")
    assert [b.text for b in leaf_blocks(html)] == ["One bold", "Two & three four", "a", "b", "5 < 6", "tail"]
    assert leaf_blocks(None) == [] and leaf_blocks("") == []


class Reader(HTMLParser):
    """Leaf blocks by the standard library's parser."""

    skip = {"script", "style", "title", "textarea", "noscript", "template", "iframe"}

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.out, self.text, self.hidden = [], [], 0
        self.feed(html)
        self.close()
        self.cut()

    def cut(self):
        text = " ".join("".join(self.text).split())
        self.out += [text] if text else []
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in self.skip:
            self.hidden += 1
            self.text.append(" ")
        elif tag == "br":
            self.text.append(" ")
        elif tag not in INLINE:
            self.cut()

    def handle_startendtag(self, tag, attrs):
        if tag not in self.skip:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in self.skip:
            self.hidden = max(0, self.hidden - 1)
        elif tag not in INLINE:
            self.cut()

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


INLINE = set("a abbr b bdo cite code em font i img input kbd label mark q s small span strong sub sup time u var math mi mo mn object".split())
UNTIDY = [
    ("<p title=it's>Hello there</p><p>It's fine</p><p>end</p>", ["Hello there", "It's fine", "end"]),
    ('<p title="5" tall">Hello there</p>', ["Hello there"]),
    ("<div class=a'b\"c id=x>one</div><p>isn't two</p>", ["one", "isn't two"]),
    ("<p data-x='a > b' data-y=\"c > d\">three</p>", ["three"]),
    ("<p>a<br>b<br/>c</p>", ["a b c"]),
    ("<ul><li>one<li>two<li>three</ul>", ["one", "two", "three"]),
    ("<p>one<p>two<div>three<p>four</div>five", ["one", "two", "three", "four", "five"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<p>5 < 6 and 7 > 2 &amp; 1 &lt; 2</p>", ["5 < 6 and 7 > 2 & 1 < 2"]),
    ("<p>caf&eacute; &#8211; &#x41;&nbsp;b &copy 2020</p>", ["café – A b © 2020"]),
    ("<P CLASS=Big>Upper</P><DIV>case</DIV>", ["Upper", "case"]),
    ("<p>x <b>bold <i>both</b> ital</i> y</p>", ["x bold both ital y"]),
    ("<!-- <p>no</p> --><p>yes</p><!-- > --><p>too</p>", ["yes", "too"]),
    ("<!DOCTYPE html><html><head><title>T <p></title><style>p > a {}</style></head><body>t", ["t"]),
    ("<script>if (a < b) { x = '</p><p>'; }</script><p>after</p>", ["after"]),
    ("<p>a<script>document.write('<p>x</p>')</script>b</p>", ["a b"]),
    ("<textarea><p>in</p></textarea><p>out</p>", ["out"]),
    ("<p\nclass='x'\n>new\n  line\t tab</p\n>", ["new line tab"]),
    ("<p>one</p></p></div><p>two</p>", ["one", "two"]),
    ("<a href=/x?a=1&b=2>link</a> and <img src=y alt='>'>text", ["link and text"]),
    ("<article><p>E = <math><mi>m</mi><mo>c</mo></math> holds</p></article>", ["E = mc holds"]),
    ("<p>old <font color=red size='2'>style</font> text</p><center>mid</center>", ["old style text", "mid"]),
    ("<p hidden>h</p><input type=text value='<p>'><p>end", ["h", "end"]),
    ("<h1>T<h2>S</h2>rest <object data=x>inner <em>text</em></object>", ["T", "S", "rest inner text"]),
]
#: What browsers make of elements that never close; the library's parser has no rule of its own for them.
UNCLOSED = [
    ("<article><p>a</p><button>x<p>b</p><p>c</p></article>", ["a", "x", "b", "c"]),
    ("<p>a <button>Share</button> b</p>", ["a b"]),
    ("<p>a <svg><path d='M0 > 1'/><text>no</text></svg> b</p>", ["a b"]),
    ("<p>a<svg><p>b</p><p>c</p>", ["a", "b", "c"]),
    ("<p>pick <select><option>1<option>2</select> one</p><select><p>x</p>", ["pick one", "x"]),
    ("<p>a</p><textarea>never closed<p>b</p>", ["a", "never closed", "b"]),
    ("<p>a<noscript>open <p>b</p>", ["a open", "b"]),
    ("<p>a <script>var x = 1;<p>b</p>", ["a", "b"]),
    ("<!--><p>a</p><!-- x --!><p>b</p>", ["a", "b"]),
]


@pytest.mark.parametrize("html,want", UNTIDY)
def test_untidy_pages_read_as_the_library_parser_reads_them(html, want):
    assert Reader(html).out == want
    assert [b.text for b in leaf_blocks(html)] == want


@pytest.mark.parametrize("html,want", UNCLOSED)
def test_elements_that_never_close_take_no_text_along(html, want):
    assert [b.text for b in leaf_blocks(html)] == want


def test_blocks_of_the_table_equal_the_library_parser(spark):
    for r in read_table(spark, "/root/testdata/sf0.01", "pages").collect():
        assert [b.text for b in leaf_blocks(r.html)] == Reader(r.html).out


def test_extraction_equals_article_elements(spark):
    pages = read_table(spark, SF, "pages")
    model = html_extract.fit(pages, layouts=250, epochs=5)
    got = {r.page_id: r for r in html_extract.extract(pages, model).collect()}
    for r in pages.collect():
        want = "\n".join(b.text for b in leaf_blocks(r.html) if "<article>" in b.path)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_labeller_on_unseen_layouts():
    import random

    rng = random.Random(5)
    words = [f"{rng.choice('bcdfgkl')}{rng.choice('aeiou')}{rng.choice('mnrst')}{rng.randint(1, 99)}" for _ in range(400)]
    lines = [" ".join(rng.choices(words, k=rng.randint(4, 20))).capitalize() + "." for _ in range(500)]
    model = html_extract.train([html_extract.layout(lines, rng) for _ in range(400)], epochs=5)
    fresh = [html_extract.layout(lines, rng) for _ in range(100)]
    labels = model.label([html_extract.features(b) for b, _ in fresh])
    y, p = np.concatenate([y for _, y in fresh]), np.concatenate(labels) >= 0.5
    assert (y == p).mean() > 0.96


def test_lstm_gradient():
    """Backpropagation through both directions equals finite differences."""
    rng = np.random.default_rng(0)
    m = html_extract.Labeller(1)
    x = rng.normal(size=(4, 2, html_extract.PATH_DIM + html_extract.WORD_DIM + 8))
    live = np.array([[1, 1], [1, 1], [1, 1], [1, 0]], bool)
    y = rng.integers(0, 2, (4, 2)).astype(float)

    def loss(x):
        p, _ = m.forward(x, live)
        return -np.where(live, y * np.log(p) + (1 - y) * np.log(1 - p), 0).sum() / live.sum()

    prob, kept = m.forward(x, live, keep=True)
    g, dx = m.backward(x, live, prob, y, kept)
    for _ in range(20):
        i = tuple(int(rng.integers(s)) for s in x.shape)
        up, down = x.copy(), x.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert np.isclose((loss(up) - loss(down)) / 2e-5, dx[i], atol=1e-7)
    for name in ("wf", "wb", "cf", "cb", "out", "bias"):
        i = tuple(int(rng.integers(s)) for s in m.p[name].shape)
        keep = m.p[name][i]
        m.p[name][i] = keep + 1e-5
        a = loss(x)
        m.p[name][i] = keep - 1e-5
        b = loss(x)
        m.p[name][i] = keep
        assert np.isclose((a - b) / 2e-5, g[name][i], atol=1e-7)


def test_html_edges(spark):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<p>plain words only in one block</p>", "x"), (2, "u", "no markup at all", "x"),
            (3, "u", "<article><p>" + "long text here. " * 30_000 + "</article>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(df, html_extract.fit(df, layouts=60, epochs=2)).collect()
    assert sorted((r.page_id or 0) for r in got) == [0, 1, 1, 2, 3]
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id == 1)
    empty = spark.createDataFrame([], df.schema)
    assert html_extract.extract(empty, html_extract.Labeller(0)).count() == 0


# --- Licences -------------------------------------------------------------------------------


def test_every_template_is_found_in_other_text():
    for k, (name, wording) in enumerate(TEMPLATES):
        found = license_scan.scan(f"Some unrelated words come first. {wording} Then others follow it.")
        assert [(TEMPLATES[f[2]][0], f[2], f[5]) for f in found] == [(name, k, [])]


def test_differences_and_near_misses():
    exact = license_scan.scan("Released under the terms of the MIT License")
    assert TEMPLATES[exact[0][2]][0] == "MIT" and exact[0][5] == ["+terms", "+of", "+the"]
    assert license_scan.scan("Licensed under the Apache License, Version 1.1.") == []
    assert license_scan.scan("The driver needs a license and permission to drive.") == []
    two = license_scan.scan("Released under the MIT License.\nbody\n\nbody two\n\nbody three\nx\nLicensed under CC BY-NC 4.0.")
    assert [TEMPLATES[f[2]][0] for f in two] == ["MIT", "CC-BY-NC-4.0"]


def test_list_marks_and_addresses_do_not_bind():
    full = {n: [w for m, w in TEMPLATES if m == n and len(w) > 250][0] for n in ("BSD-3-Clause", "BSD-2-Clause", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GPL-3.0")}
    for name, wording in full.items():
        for text in (wording, re.sub(r"\b[123]\. ", "* ", wording), re.sub(r"\b([123])\. ", r"(\1) ", wording),
                     wording.replace("51 Franklin Street, Fifth Floor", "59 Temple Place, Suite 330").replace("02110-1301", "02111-1307")):
            assert [TEMPLATES[f[2]][0] for f in license_scan.scan(f"A first line of other words.\n{text}\nThe end.")] == [name]
    # A version, a clause or another licence's name does bind.
    assert not license_scan.scan(full["GPL-3.0"].replace("version 3", "version 7"))
    assert not license_scan.scan("Licensed under CC BY-NC 3.0.") and not license_scan.scan("Licensed under CC BY-NC-ND 4.0.")


def test_a_lower_ranked_notice_is_still_compared():
    """A block of many cues in which several templates save more bytes than the one that is there."""
    parts = [" ".join(w.split()[:len(w.split()) // 2]) for n, w in TEMPLATES if len(w) > 250]
    notice = [w for n, w in TEMPLATES if n == "ISC"][0]
    found = license_scan.scan(". ".join([*parts, notice]) + ".")
    assert "ISC" in [TEMPLATES[f[2]][0] for f in found]


def test_notices_equal_plain_search(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = sorted((r.doc_id, r.start, r.license) for r in license_scan.notices(docs).collect())
    plain = {"Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0": "Apache-2.0",
             "Released under the MIT License": "MIT", "This work is licensed under the GNU General Public License, version 3": "GPL-3.0"}
    want = sorted((r.doc_id, m.start(), plain[m.group()]) for r in docs.collect() for m in re.finditer("|".join(plain), r.text))
    assert got == want


def test_licence_edges(spark):
    df = to_spark(spark, documents(), DOC_SCHEMA)
    assert license_scan.notices(df).count() == 0
    assert license_scan.notices(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    rows = [(None, "Released under the MIT License."), (1, None), (1, "Released under the MIT License."), (1, "Released under the MIT License.")]
    assert license_scan.notices(spark.createDataFrame(rows, "doc_id long, text string")).count() == 3

