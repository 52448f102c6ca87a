"""Licence notices found by conditional compression and confirmed by exact wording.

Candidate blocks are runs of sentences that hold a licence cue (gaps of up to ``GAP`` sentences
are bridged, for long notices). Each block is compressed with zstandard on its own and with every
template as a raw-content dictionary; a template that shares wording makes the block smaller, and
templates are ranked by that saving. From the largest saving down, every template with a
positive one is compared word by word, unless it shares too few words with the block to reach
``MIN_SHARE`` in any order: the template is aligned in the block, and missing, changed and inserted
words are listed. A template is confirmed when the share of its words found in order is at least
``MIN_SHARE`` and no binding word differs: the name of a licence, a Creative Commons clause, or a
number that stands with ``version`` or a licence's name. Numbers of lists do not bind. Of the
confirmed templates the one with most words found, less the differences, wins.

A block that holds several notices is cut at the confirmed notice, and the rests are scanned
again until nothing more is confirmed. Every row and whole text is read; templates are code, so
nothing is broadcast or shuffled, and a lost task is simply run again.

Defined results: null and empty texts have no notices; null and repeated ids are passed on (one
row per notice and row); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgsift.llm.license_templates import CUES, TEMPLATES

MIN_SHARE = 0.8
GAP = 2
LEVEL = 3
#: Words that change which licence a notice names.
NAMES = frozenset("lesser affero general mit apache bsd mozilla gnu noncommercial sharealike attribution noderivatives".split())
#: Clauses of a Creative Commons licence, and words before a number that make it a version.
CLAUSES = frozenset("by nc nd sa".split())
VERSIONED = NAMES | CLAUSES | frozenset("version v license licence cc cc0 gpl lgpl agpl mpl public".split())
_CUE = re.compile(rf"\b(?:{'|'.join(CUES)})|\"as is\"", re.I)
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?](?=\s|$)|\n|$)")
_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")

_compilers: list[tuple[zstd.ZstdCompressor, list[str], Counter]] = []


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _templates():
    """(compressor with the template as raw dictionary, its words, their counts), built once per worker."""
    if not _compilers:
        for _, wording in TEMPLATES:
            words = _words(wording)
            raw = zstd.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT)
            _compilers.append((zstd.ZstdCompressor(level=LEVEL, dict_data=raw), words, Counter(words)))
    return _compilers


_plain = zstd.ZstdCompressor(level=LEVEL)


def candidate_blocks(text: str | None) -> list[tuple[int, int]]:
    """[start, end) runs of sentences around licence cues."""
    if not text:
        return []
    low = text.lower()
    # Plain substring searches pass over texts without cues much faster than the pattern does.
    if not any(c in low for c in CUES) or not _CUE.search(text):
        return []
    blocks: list[list[int]] = []
    k, last, at = 0, -10, 0
    while at < len(text):
        m = _SENTENCE.match(text, at)
        a, b = at, max(m.end(), at + 1)
        at = b
        if not text[a:b].strip():
            continue
        if _CUE.search(text, a, b):
            if k - last <= GAP + 1 and blocks:
                blocks[-1][1] = b
            else:
                blocks.append([a, b])
            last = k
        k += 1
    return [(a, b) for a, b in blocks]


def rank_templates(words: list[str]) -> list[tuple[int, int]]:
    """(saved bytes, template) from the largest saving down."""
    block = " ".join(words).encode()
    alone = len(_plain.compress(block))
    return sorted(((alone - len(c.compress(block)), k) for k, (c, _, _) in enumerate(_templates())), key=lambda x: (-x[0], x[1]))


def _binds(words: list[str], i: int) -> bool:
    """Whether the word names a licence, one of its clauses or its version."""
    w, before, after = words[i], words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""
    if w in CLAUSES:
        return before in CLAUSES or before == "cc" or after in CLAUSES or "." in after
    return w in NAMES or w[0].isdigit() and (before in VERSIONED or after == "clause")


def wording(template: list[str], words: list[str]) -> tuple[int, list[str], bool, int, int]:
    """(template words found in order, differences, whether one binds, first and last matched word of the block)."""
    pairs = SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks()[:-1]
    # Stray single words far from the notice would stretch it: keep the densest neighbourhood.
    best, run = [], []
    for p in pairs:
        if run and p.b - (run[-1].b + run[-1].size) > max(6, len(template) // 4):
            run = []
        run.append(p)
        if sum(x.size for x in run) > sum(x.size for x in best):
            best = list(run)
    if not best:
        return 0, [], True, 0, 0
    missing, inserted = [], []
    differ: list[str] = []
    a, b = 0, best[0].b
    for p in best:
        missing += range(a, p.a)
        inserted += range(b, p.b)
        differ += [f"-{w}" for w in template[a:p.a]] + [f"+{w}" for w in words[b:p.b]]
        a, b = p.a + p.size, p.b + p.size
    missing += range(a, len(template))
    differ += [f"-{w}" for w in template[a:]]
    binds = any(_binds(template, i) for i in missing) or any(_binds(words, i) for i in inserted)
    return sum(p.size for p in best), differ, binds, best[0].b, b


def scan(text: str | None) -> list[tuple[int, int, int, float, float, list[str]]]:
    """(start, end, template, saved share, found share, differences) of the notices of a text."""
    found = []
    todo = candidate_blocks(text)
    while todo:
        a, b = todo.pop()
        at = [(m.start() + a, m.end() + a) for m in _WORD.finditer(text[a:b])]
        words = [text[x:y].lower() for x, y in at]
        if len(words) < 3:
            continue
        ranked = rank_templates(words)
        alone = max(len(_plain.compress(" ".join(words).encode())), 1)
        has = Counter(words)
        best = None
        for saved, k in (r for r in ranked if r[0] > 0):
            _, template, counts = _templates()[k]
            if sum(min(n, has[w]) for w, n in counts.items()) < MIN_SHARE * len(template):
                continue
            hit, differ, binds, lo, hi = wording(template, words)
            if hit >= MIN_SHARE * len(template) and not binds:
                rank = (hit - len(differ), saved, -k)
                if best is None or rank > best[0]:
                    best = (rank, k, saved, hit / len(template), differ, lo, hi)
        if best is None:
            # A notice may hide in a long block: look at its sentences one by one.
            cut = [(m.start(), m.end()) for m in _SENTENCE.finditer(text, a, b) if m.end() > m.start()]
            parts = [(x, y) for x, y in cut if _CUE.search(text, x, y)]
            if len(cut) > 1:
                todo += parts
            continue
        _, k, saved, share, differ, lo, hi = best
        start, end = at[lo][0], at[hi - 1][1]
        found.append((start, end, k, saved / alone, share, differ))
        todo += [(x, y) for x, y in ((a, start), (end, b)) if _CUE.search(text, x, y)]
    return sorted(found)


def notices(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per notice: doc_id, start, end, license, template, saving, share, differences, exact."""
    base = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cols = [], [[] for _ in range(8)]
            for lo in range(0, len(batch), 256):
                for i, t in enumerate(batch.column(1).slice(lo, 256).to_pylist()):
                    for a, b, k, saving, share, differ in scan(t):
                        rows.append(lo + i)
                        for c, v in zip(cols, (a, b, TEMPLATES[k][0], k, saving, share, differ, not differ), strict=True):
                            c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                ["doc_id", "start", "end", "license", "template", "saving", "share", "differences", "exact"])

    return base.mapInArrow(run, f"doc_id {kind}, start long, end long, license string, template int, saving double, "
                                "share double, differences array<string>, exact boolean")
