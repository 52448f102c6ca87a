"""HTML main-text extraction with a recurrent block labeller.

A page is cut into leaf blocks (``html_blocks``). Each block is read as vectors: learned
embeddings of its hashed tag path (elements, words of class, id and role), learned embeddings of
its hashed words, and a few numbers (length, link share, punctuation, position). A numpy
bidirectional LSTM runs over the whole sequence, so every block is classified with the context of
the entire document, and the blocks labelled as content are joined in page order.

Training: there are no labelled pages, so the model is fitted at query time on (a) a bounded,
documented sample of the table's own pages (``SAMPLE_PAGES`` of at most ``SAMPLE_CHARS`` characters,
in hash order) labelled by what
their HTML5 elements say (inside ``article``/``main``, outside ``nav``, ``aside``, ``footer``
...), and (b) generated layouts that put sentences of that sample into many common templates -
semantic, class-named and plain - with menus, notices, adverts, forms, related links and reader
comments. A dropout on path marks makes the model use words and context as well. The weights are
the only broadcast (a few 100 kB). Every page is labelled over its whole html.

Defined results: null and empty html have no text; a page without content blocks has an empty
text; null or repeated page ids and urls are passed on; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import random
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgsift.llm._features import words_of
from msgsift.llm.html_blocks import Block, leaf_blocks

PATH_SLOTS, WORD_SLOTS = 2048, 4096
PATH_DIM, WORD_DIM, HIDDEN = 24, 12, 24
SAMPLE_PAGES, SAMPLE_CHARS = 200, 100_000
LAYOUTS = 600
EPOCHS = 6
#: Pages labelled together; only similar lengths share a group.
GROUP = 128

_MEMO_LIMIT = 300_000
_path_slots: dict[tuple[str, ...], list[int]] = {}


def _path(path: tuple[str, ...]) -> list[int]:
    if path not in _path_slots:
        if len(_path_slots) > _MEMO_LIMIT:
            _path_slots.clear()
        _path_slots[path] = [crc32(m.encode("utf-8", "surrogatepass")) % PATH_SLOTS for m in path] or [0]
    return _path_slots[path]


class Features(NamedTuple):
    paths: list[list[int]]  # slots of each block's path marks
    words: np.ndarray  # word slots of all blocks, one after the other
    sizes: np.ndarray  # words per block
    nums: np.ndarray


def features(blocks: list[Block]) -> Features:
    """Path slots, word slots and numbers of each block; every word of the page counts."""
    paths, nums = [], np.zeros((len(blocks), 8), np.float32)
    words, sizes = words_of([b.text for b in blocks], WORD_SLOTS)
    for i, b in enumerate(blocks):
        paths.append(_path(b.path))
        n, count, m = len(b.text), b.text.count, max(int(sizes[i]), 1)
        nums[i] = (np.log1p(m) / 4, min(b.link_chars / n, 1.0),
                   (count(".") + count(",") + count("!") + count("?") + count(";")) / m,
                   b.text[-1] in ".!?:\"", i / len(blocks), 1 / (i + 1), 1 / (len(blocks) - i), 1.0)
    return Features(paths, words, sizes, nums)


def _bags(table: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each bag's rows over the square root of its size (zeros for an empty bag)."""
    out = np.zeros((len(sizes), table.shape[1]), table.dtype)
    full = sizes > 0
    if full.any():
        starts = (np.cumsum(sizes) - sizes)[full]
        out[full] = np.add.reduceat(table[flat], starts, axis=0) / np.sqrt(sizes[full])[:, None].astype(table.dtype)
    return out


def _flat(paths: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, paths), np.int64, len(paths))
    return np.fromiter((x for p in paths for x in p), np.int64, int(sizes.sum())), sizes


class Labeller:
    """Embeddings, two LSTM directions and a logistic output; forward and backward in numpy."""

    def __init__(self, seed: int = 0, state: dict[str, np.ndarray] | None = None):
        if state is not None:
            self.p = state
            return
        rng = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + 8
        self.p = {"path": rng.normal(0, 0.3, (PATH_SLOTS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_SLOTS, WORD_DIM))}
        for side in "fb":
            self.p["w" + side] = rng.normal(0, 1 / np.sqrt(d + HIDDEN), (d + HIDDEN, 4 * HIDDEN))
            self.p["c" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.p["out"] = rng.normal(0, 0.1, 2 * HIDDEN + d)
        self.p["bias"] = np.zeros(1)

    def embed(self, f: Features) -> np.ndarray:
        return np.concatenate([_bags(self.p["path"], *_flat(f.paths)), _bags(self.p["word"], f.words, f.sizes),
                               f.nums.astype(self.p["out"].dtype)], axis=1)

    def _run(self, x: np.ndarray, live: np.ndarray, side: str, keep: bool):
        """x (T, N, d); live (T, N) marks real steps; the state passes unchanged over padding."""
        t_max, n, _ = x.shape
        w, c0 = self.p["w" + side], self.p["c" + side]
        h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
        out, tape = np.zeros((t_max, n, HIDDEN), x.dtype), {}
        for t in range(t_max) if side == "f" else range(t_max - 1, -1, -1):
            z = np.concatenate([x[t], h], axis=1)
            a = z @ w + c0
            gates = 1 / (1 + np.exp(-np.clip(a[:, :3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(a[:, 3 * HIDDEN:])
            on = live[t][:, None]
            c_new = np.where(on, f * c + i * g, c)
            th = np.tanh(c_new)
            h_new = np.where(on, o * th, h)
            if keep:
                tape[t] = (z, i, f, o, g, c, th, on)
            h, c = h_new, c_new
            out[t] = h
        return out, tape

    def forward(self, x: np.ndarray, live: np.ndarray, keep: bool = False):
        hf, tf = self._run(x, live, "f", keep)
        hb, tb = self._run(x, live, "b", keep)
        z = np.concatenate([hf, hb, x], axis=2)
        prob = 1 / (1 + np.exp(-np.clip(z @ self.p["out"] + self.p["bias"], -30, 30)))
        return prob, (z, tf, tb)

    def backward(self, x, live, prob, y, kept) -> tuple[dict[str, np.ndarray], np.ndarray]:
        z, tf, tb = kept
        err = np.where(live, prob - y, 0.0) / live.sum()
        g = {"out": np.einsum("tn,tnd->d", err, z), "bias": np.array([err.sum()])}
        dz = err[:, :, None] * self.p["out"]
        dx = dz[:, :, 2 * HIDDEN:].copy()
        for side, tape, dh_out in (("f", tf, dz[:, :, :HIDDEN]), ("b", tb, dz[:, :, HIDDEN:2 * HIDDEN])):
            w = self.p["w" + side]
            gw, gc = np.zeros_like(w), np.zeros(4 * HIDDEN)
            dh, dc = np.zeros(dh_out.shape[1:]), np.zeros(dh_out.shape[1:])
            steps = range(len(x) - 1, -1, -1) if side == "f" else range(len(x))
            for t in steps:
                zt, i, f, o, cand, c_old, th, on = tape[t]
                total = dh + dh_out[t]
                dc_all = dc + np.where(on, total * o * (1 - th * th), 0.0)
                da = np.concatenate([dc_all * cand * i * (1 - i), dc_all * c_old * f * (1 - f),
                                     total * th * o * (1 - o), dc_all * i * (1 - cand * cand)], axis=1)
                da = np.where(on, da, 0.0)
                gw += zt.T @ da
                gc += da.sum(axis=0)
                back = da @ w.T
                dx[t] += back[:, :x.shape[2]]
                dh = np.where(on, back[:, x.shape[2]:], total)
                dc = np.where(on, dc_all * f, dc)
            g["w" + side], g["c" + side] = gw, gc
        return g, dx

    def label(self, pages: list[Features]) -> list[np.ndarray]:
        """Content probability of each block of each page (features), grouped by similar length."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i].sizes)), key=lambda i: len(pages[i].sizes))
        for lo in range(0, len(order), GROUP):
            ids = order[lo:lo + GROUP]
            x, live = _pad([self.embed(pages[i]) for i in ids])
            prob, _ = self.forward(x, live)
            for k, i in enumerate(ids):
                out[i] = prob[:len(pages[i].sizes), k]
        return out


def _pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(s) for s in seqs)
    x, live = np.zeros((t, len(seqs), seqs[0].shape[1]), seqs[0].dtype), np.zeros((t, len(seqs)), bool)
    for k, s in enumerate(seqs):
        x[:len(s), k], live[:len(s), k] = s, True
    return x, live


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, batch: int = 16, seed: int = 0) -> Labeller:
    """Adam on the logistic loss; path marks are dropped at random so that context counts too."""
    model, rng = Labeller(seed), np.random.default_rng(seed)
    m1 = {k: np.zeros_like(v) for k, v in model.p.items()}
    m2 = {k: np.zeros_like(v) for k, v in model.p.items()}
    data = [(features(b), np.array(y, float)) for b, y in pages if b]
    step, total = 0, epochs * (len(data) // batch + 1)
    for _ in range(epochs):
        order = sorted(range(len(data)), key=lambda i: (len(data[i][1]) // 8, rng.random()))
        groups = [order[k:k + batch] for k in range(0, len(order), batch)]
        for gi in rng.permutation(len(groups)):
            ids = groups[gi]
            feats = []
            for i in ids:
                f = data[i][0]
                hide = rng.random() < 0.25
                chance = 0.5 if hide else 0.08
                keep = [[a for a, z in zip(p, rng.random(len(p)), strict=True) if z > chance] or p[:1] for p in f.paths]
                feats.append(f._replace(paths=keep))
            x, live = _pad([model.embed(f) for f in feats])
            y, _ = _pad([data[i][1][:, None] for i in ids])
            prob, kept = model.forward(x, live, keep=True)
            g, dx = model.backward(x, live, prob, y[:, :, 0], kept)
            g["path"], g["word"] = np.zeros_like(model.p["path"]), np.zeros_like(model.p["word"])
            for k, f in enumerate(feats):
                at, sizes = _flat(f.paths)
                d = dx[:len(sizes), k]
                np.add.at(g["path"], at, np.repeat(d[:, :PATH_DIM] / np.sqrt(sizes)[:, None], sizes, axis=0))
                per = d[:, PATH_DIM:PATH_DIM + WORD_DIM] / np.sqrt(np.maximum(f.sizes, 1))[:, None]
                np.add.at(g["word"], f.words, np.repeat(per, f.sizes, axis=0))
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            rate = 0.01 * min(1.0, 2.5 * (1 - step / (total + 1)))
            for name, v in g.items():
                v = v / max(1.0, norm)
                m1[name] = 0.9 * m1[name] + 0.1 * v
                m2[name] = 0.99 * m2[name] + 0.01 * v * v
                model.p[name] -= rate * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.99**step)) + 1e-8)
    return model


# Element and attribute words that mark page furniture and content.
FURNITURE_ELEMENTS = frozenset("<nav> <aside> <footer> <header> <form> <menu> <dialog> <address>".split())
CONTENT_ELEMENTS = frozenset("<article> <main>".split())
CONTENT_NAMES = ("content post-content entry-content article-body post story main-content body-text page-content text "
                 "article__body blog-post entry main prose markdown-body node-content").split()
MENU_NAMES = "nav menu navbar main-menu breadcrumb breadcrumbs topbar site-nav navigation tabs pagination pager toc".split()
HEADER_NAMES = "header site-header masthead banner logo branding top page-header brand".split()
FOOTER_NAMES = "footer site-footer copyright bottom foot colophon legal".split()
SIDE_NAMES = "sidebar side widget related rail aside popular trending more-stories recommended col-right see-also".split()
NOTICE_NAMES = "cookie-notice cookie-banner consent gdpr notice alert popup modal banner-message overlay announcement disclaimer".split()
ADVERT_NAMES = "ad ads advert advertisement sponsored promo ad-slot adsense promoted sponsor banner-ad".split()
FORM_NAMES = "newsletter subscribe signup search login contact-form form search-form".split()
COMMENT_NAMES = "comments comment comment-list responses discussion disqus replies reply comment-body thread".split()
SHARE_NAMES = "share social social-links share-buttons tags tag-list byline meta author post-meta author-box".split()
MENU_WORDS = "Home About Contact News Blog Products Services Help Login Register Sitemap Privacy Terms Archive Search Categories Jobs Shop".split()
NOTICE_LINES = ("We use cookies to improve your experience.", "By continuing to use this site you accept our cookie policy.",
                "This website uses cookies.", "Accept all cookies", "Please enable JavaScript to view this page.",
                "You have reached your limit of free articles.", "Sign up to continue reading.")
FORM_LINES = ("Subscribe to our newsletter", "Enter your email address", "Your name", "Sign up", "Leave a comment", "Send", "Search this site")
ADVERT_LINES = ("Advertisement", "Sponsored", "Ad", "Promoted content", "Buy now and save 20%", "Click here for the best offers")
FOOTER_LINES = ("All rights reserved.", "© 2024", "Privacy policy", "Terms of use", "Powered by", "Contact us", "Back to top")
SHARE_LINES = ("Share this article", "Tweet", "Share on Facebook", "Posted by admin", "Read more", "Related articles", "Most popular", "Tags:")
COMMENT_LINES = ("Reply", "3 comments", "Log in to reply", "says:", "Report", "Great article, thanks!", "I do not agree.", "Leave a reply")


def weak_labels(blocks: list[Block]) -> list[int] | None:
    """1 for blocks that the page's own elements put into its article; None if it has none."""
    inside = [int(bool(CONTENT_ELEMENTS & set(b.path)) and not (FURNITURE_ELEMENTS & set(b.path))) for b in blocks]
    return inside if any(inside) and not all(inside) else None


def layout(sentences: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A generated page of a random template, filled with the given sentences, and its labels."""
    html: list[str] = []

    def text(lo, hi):
        return " ".join(rng.choice(sentences) for _ in range(rng.randint(lo, hi)))

    def words(k):
        return " ".join(rng.choice(sentences).split()[:k])

    def esc(s):
        return s.replace("&", "&amp;").replace("<", "&lt;")

    mark = {1: "\x01", 0: "\x02"}
    style = rng.choice(["semantic", "named", "named", "plain"])

    def put(tag, body, good, attr=""):
        html.append(f"<{tag}{attr}>{mark[good]}{esc(body)}</{tag}>" if rng.random() > 0.1 or tag != "p"
                    else f"<{tag}{attr}>{mark[good]}{esc(body)}")

    def box(names, element):
        if style == "semantic" and rng.random() < 0.7 and element:
            return (element, "")
        if style == "plain" and rng.random() < 0.7:
            return ("div", "")
        key = rng.choice(["class", "class", "id"])
        return (rng.choice(["div", "div", "section", element or "div"]), f' {key}="{rng.choice(names)}"')

    def links(k, good=0):
        for _ in range(k):
            label = rng.choice(MENU_WORDS) if rng.random() < 0.4 else words(rng.randint(1, 5))
            html.append(f'<li><a href="/{rng.randint(1, 99)}">{mark[good]}{esc(label)}</a></li>')

    def furniture(names, element, lines, long=False):
        tag, attr = box(names, element)
        html.append(f"<{tag}{attr}>")
        for _ in range(rng.randint(1, 3)):
            roll = rng.random()
            if roll < 0.4 or style == "plain":
                put(rng.choice(["p", "div", "span", "h4"]), rng.choice(lines) + (f" {words(4)}" if rng.random() < 0.3 else ""), 0)
            elif roll < 0.8 or long:
                put(rng.choice(["p", "div"]), text(1, 3 if long else 2), 0)
            else:
                html.append("<ul>")
                links(rng.randint(2, 5))
                html.append("</ul>")
        html.append(f"</{tag}>")

    def menu():
        tag, attr = box(MENU_NAMES, "nav")
        html.append(f"<{tag}{attr}><ul>")
        links(rng.randint(3, 9))
        html.append(f"</ul></{tag}>")

    def content():
        tag, attr = box(CONTENT_NAMES, rng.choice(["article", "main"]))
        html.append(f"<{tag}{attr}>")
        put(rng.choice(["h1", "h1", "h2"]), words(rng.randint(2, 9)), 1)
        if rng.random() < 0.2:
            furniture(SHARE_NAMES, None, SHARE_LINES)
        for _ in range(rng.choice([1, 2, 4, 7, 12, 20])):
            roll = rng.random()
            if roll < 0.72:
                put("p", text(1, 8) if rng.random() < 0.8 else words(rng.randint(1, 3)), 1)
            elif roll < 0.78:
                put(rng.choice(["h2", "h3"]), words(rng.randint(1, 6)), 1)
            elif roll < 0.84:
                html.append("<ul>")
                for _ in range(rng.randint(2, 5)):
                    put("li", words(rng.randint(3, 12)), 1)
                html.append("</ul>")
            elif roll < 0.88:
                put("blockquote", text(1, 2), 1)
            elif roll < 0.92:
                put("div", text(1, 4), 1)
            elif style != "plain":
                kind = rng.choice([(ADVERT_NAMES, "aside", ADVERT_LINES), (FORM_NAMES, "form", FORM_LINES),
                                   (SHARE_NAMES, None, SHARE_LINES), (SIDE_NAMES, "aside", SHARE_LINES),
                                   (NOTICE_NAMES, None, NOTICE_LINES)])
                furniture(*kind)
        html.append(f"</{tag}>")

    def comments():
        if style == "plain":
            return
        tag, attr = rng.choice(["section", "div"]), f' {rng.choice(["class", "id"])}="{rng.choice(COMMENT_NAMES)}"'
        html.append(f"<{tag}{attr}>")
        for _ in range(rng.randint(1, 5)):
            inner = f' class="{rng.choice(COMMENT_NAMES)}"' if rng.random() < 0.5 else ""
            html.append(f"<div{inner}>")
            put(rng.choice(["h4", "span", "cite", "div"]), words(2) if rng.random() < 0.5 else rng.choice(COMMENT_LINES), 0)
            put("p", text(1, 3), 0)
            html.append("</div>")
        html.append(f"</{tag}>")

    before = [lambda: furniture(HEADER_NAMES, "header", FOOTER_LINES + SHARE_LINES), menu,
              lambda: furniture(NOTICE_NAMES, "dialog", NOTICE_LINES), lambda: furniture(ADVERT_NAMES, "aside", ADVERT_LINES, True),
              lambda: furniture(SIDE_NAMES, "aside", SHARE_LINES, True), lambda: furniture(FORM_NAMES, "form", FORM_LINES)]
    after = [comments, lambda: furniture(SIDE_NAMES, "aside", SHARE_LINES, True), lambda: furniture(FORM_NAMES, "form", FORM_LINES),
             lambda: furniture(ADVERT_NAMES, "aside", ADVERT_LINES, True), lambda: furniture(NOTICE_NAMES, None, NOTICE_LINES), menu,
             lambda: furniture(FOOTER_NAMES, "footer", FOOTER_LINES, True)]
    rng.shuffle(before)
    for part in before[:rng.randint(0, 4)]:
        part()
    content()
    for part in [p for p in after if rng.random() < 0.45]:
        part()
    blocks, labels = [], []
    for b in leaf_blocks("<html><body>" + "".join(html) + "</body></html>"):
        labels.append(int("\x01" in b.text))
        clean = b.text.replace("\x01", "").replace("\x02", "").strip()
        if clean:
            blocks.append(b._replace(text=clean))
        else:
            labels.pop()
    return blocks, labels


def training_pages(html: list[str], layouts: int = LAYOUTS, seed: int = 0) -> list[tuple[list[Block], list[int]]]:
    """Weakly labelled real pages and generated layouts filled with their sentences."""
    rng, pages, sentences = random.Random(seed), [], []
    for page in html:
        blocks = leaf_blocks(page)
        labels = weak_labels(blocks)
        if labels:
            pages.append((blocks, labels))
        for b in blocks:
            sentences.extend(s.strip() + "." for s in b.text.split(". ")[:8] if s.strip(". "))
    sentences = sentences or ["This is a plain sentence about the topic of the page.", "Another sentence follows it."]
    rng.shuffle(sentences)
    return pages + [layout(sentences, rng) for _ in range(layouts)]


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES,
        layouts: int = LAYOUTS, epochs: int = EPOCHS) -> Labeller:
    """Fit from at most ``sample`` pages of up to ``SAMPLE_CHARS`` characters, in hash order of their html."""
    rows = pages.where(F.length(html_col).between(1, SAMPLE_CHARS)).select(F.xxhash64(html_col).alias("h"), F.col(html_col).alias("t"))
    chosen = rows.select("h").distinct().orderBy("h").limit(sample)
    taken = rows.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).orderBy("h").limit(sample).collect()
    return train(training_pages([r["t"] for r in taken], layouts), epochs)


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast({k: v.astype(np.float32) for k, v in model.p.items()})

    def run(htmls: pd.Series) -> pd.Series:
        m, out = Labeller(state=shared.value), []
        for lo in range(0, len(htmls), 512):
            blocks = [leaf_blocks(h) for h in htmls.iloc[lo:lo + 512]]
            labels = m.label([features(b) for b in blocks])
            out += ["\n".join(b.text for b, p in zip(bs, ps, strict=True) if p >= 0.5) for bs, ps in zip(blocks, labels, strict=True)]
        return pd.Series(out, dtype=object)

    text = F.pandas_udf(run, "string")(F.col(html_col))
    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
