"""Substring dedup by hashed paragraphs: the earliest ranked occurrence stays.

A text's paragraphs are its lines. A line is cut further into sentences, so that a passage pasted
into a line is still found: a unit is a sentence of at least ``MIN_SENTENCE`` words, or a run of
shorter ones between two such. In scripts without spaces two characters count as a word. Units are normalised (white space runs become one space, trimmed,
lower-cased) and hashed to 128 bits over all documents; blank units are skipped. The occurrence
with the smallest (doc id, offset) is the one that stays.

Neighbouring repeated units (nothing but white space between) form a span. Its ends may reach into
the units next to it: the words before the span that equal those before the kept occurrence of its
first unit, and the words after it that equal those after the kept occurrence of its last unit,
belong to it. Spans of at least ``min_words`` words, these partial units counted, are removed;
shorter repeats (stock phrases, a line of a few words) stay. Offsets are code points of the original
text; the cleaned text keeps the offsets of the pieces it is made of.

Each unit digest is grouped with partial aggregation for its first occurrence and count, so a
unit on every page is one row per task. Only digests seen more than once come back, and only
units that are not the first occurrence are gathered per document, which is bounded by the
document. Texts are read again only for spans that their neighbours could make long enough. Hot digests are split by adaptive skew handling in the join.

Defined results: null and empty texts have no units; a null id ranks last; rows that repeat an
id share one identity by (id, text digest), and repeated rows of equal id and text are one
document; empty tables give empty results; extra columns pass through ``remove_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgsift.llm._common import fresh, shared_table, small_or_shuffled

MIN_SENTENCE = 5
MIN_WORDS = 40
_ANY = re.compile(r"\S+")
_LINE = re.compile(r"[^\n]+")
_SENTENCE = re.compile(r"[^\s。！？][^.!?。！？]*(?:[.!?]+(?=[^\s。！？])[^.!?。！？]*)*(?:[.!?。！？]+|$)|[。！？]+")
#: Thai to Khmer, kana, CJK ideographs: written without spaces between words.
_SPACELESS = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")


def n_words(words: list[str]) -> int:
    """Number of words; in scripts without spaces two characters count as one."""
    return sum(1 if w.isascii() else max(1, len(_SPACELESS.findall(w)) // 2) for w in words)


def is_sentence(words: list[str]) -> bool:
    """Whether the words are enough for a unit of their own."""
    return n_words(words) >= MIN_SENTENCE


def units(text: str | None) -> list[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of the units of a text, in order."""
    out: list[tuple[int, int, int, bytes]] = []
    for line in _LINE.finditer(text or ""):
        s, base = line.group(), line.start()
        parts: list[tuple[int, int, list[str], bool]] = []  # start, end, words, long
        for m in _SENTENCE.finditer(s):
            words = m.group().split()
            is_long = is_sentence(words)
            if parts and not is_long and not parts[-1][3]:
                a, _, before, _ = parts[-1]
                parts[-1] = (a, m.end(), before + words, False)
            else:
                parts.append((m.start(), m.end(), words, is_long))
        for a, b, words, _ in parts:
            norm = " ".join(words).lower().encode("utf-8", "surrogatepass")
            out.append((base + a, base + b, n_words(words), blake2b(norm, digest_size=16).digest()))
    return out


_UNIT = "pos int, start int, stop int, words int, before int, b_start int, after int, a_stop int, digest binary"


def unit_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, sig, pos, start, stop, words, before, b_start, after, a_stop, digest): every unit of every
    document, with the words and the outer offset of the units before and after it."""
    base = df.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("sig"), F.col(text_col).alias("t"))
    kind = base.schema["doc"].dataType
    names = [f.split()[0] for f in _UNIT.split(", ")]

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, sigs = batch.column(0), batch.column(1)
            for lo in range(0, len(docs), 256):
                at, rows = [], []
                for i, t in enumerate(batch.column(2).slice(lo, 256).to_pylist()):
                    found = units(t)
                    none = (0, 0, 0, b"")
                    for k, (a, b, n, d) in enumerate(found):
                        prev = found[k - 1] if k else (a, a, 0, b"")
                        after = found[k + 1] if k + 1 < len(found) else none
                        at.append(lo + i)
                        rows.append((k, a, b, n, prev[2], prev[0], after[2], after[1] or b, d))
                keep = pa.array(at, pa.int64())
                cols = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [docs.take(keep), sigs.take(keep), *[pa.array(c, pa.binary() if f == "digest" else pa.int32()) for f, c in zip(names, cols, strict=True)]],
                    ["doc", "sig", *names])

    return base.mapInArrow(explode, f"doc {kind.simpleString()}, sig long, {_UNIT}")


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The units whose earliest occurrence is elsewhere; ``k`` is that occurrence."""
    all_units = shared_table(unit_table(df, id_col, text_col), "sub-units")
    rank = F.struct(F.col("doc").isNull().alias("last"), *[F.col(c) for c in (
        "doc", "sig", "pos", "start", "stop", "before", "b_start", "after", "a_stop")])
    seen = all_units.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    seen = shared_table(seen.select(F.col("digest").alias("d"), F.col("first").dropFields("last").alias("k")), "sub-first")
    # Repeated digests grow with the corpus: the join is a shuffle at every size.
    met = all_units.join(seen.hint("merge"), F.col("digest") == F.col("d"))
    first = F.col("doc").eqNullSafe(F.col("k.doc")) & (F.col("sig") == F.col("k.sig")) & (F.col("pos") == F.col("k.pos"))
    return met.where(~first).drop("digest", "d")


def runs_of(again: DataFrame, min_words: int) -> DataFrame:
    """Runs of neighbouring repeated units that could reach ``min_words`` with their neighbours."""
    u = F.struct("pos", "start", "stop", "words", "before", "b_start", "after", "a_stop", "k")
    per_doc = again.groupBy("doc", "sig").agg(F.sort_array(F.collect_set(u)).alias("u"))
    # Sorted by position: a run of consecutive positions has a constant pos - rank.
    ranked = per_doc.select("doc", "sig", F.posexplode("u").alias("r", "x"))
    runs = ranked.groupBy("doc", "sig", (F.col("x.pos") - F.col("r")).alias("run")).agg(
        F.min("x").alias("a"), F.max("x").alias("z"), F.sum("x.words").alias("n_words"), F.count(F.lit(1)).alias("n_units"),
        F.sort_array(F.collect_set("x.k.doc")).alias("keep_ids"))
    reach = F.col("n_words") + F.least("a.before", "a.k.before") + F.least("z.after", "z.k.after")
    return runs.where(reach >= min_words).drop("run")


def _extension(own: pd.Series, kept: pd.Series, backwards: bool) -> pd.DataFrame:
    """(words, chars): how many words next to a span equal those next to the kept occurrence, and how
    many characters of the own text they take."""
    out = []
    for o, k in zip(own, kept, strict=True):
        mine = [(m.start(), m.end(), m.group().lower()) for m in _ANY.finditer(o or "")]
        other = [w.lower() for w in (k or "").split()]
        if backwards:
            mine.reverse()
            other.reverse()
        n = 0
        while n < min(len(mine), len(other)) and mine[n][2] == other[n]:
            n += 1
        out.append((n, 0 if not n else len(o) - mine[n - 1][0] if backwards else mine[n - 1][1]))
    return pd.DataFrame(out, columns=["words", "chars"])


def _beside(runs: DataFrame, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The runs with the texts beside them and beside their kept occurrences: ol, kl, or, kr."""
    def ask(side, doc, sig, a, b):
        return F.struct(F.lit(side).alias("side"), F.col(doc).alias("td"), F.col(sig).alias("ts"), F.col(a).alias("from"), F.col(b).alias("to"))

    asked = runs.select("doc", "sig", F.col("a.start").alias("at"), F.explode(F.array(
        ask("ol", "doc", "sig", "a.b_start", "a.start"), ask("kl", "a.k.doc", "a.k.sig", "a.k.b_start", "a.k.start"),
        ask("or", "doc", "sig", "z.stop", "z.a_stop"), ask("kr", "z.k.doc", "z.k.sig", "z.k.stop", "z.k.a_stop"))).alias("q"))
    asked = shared_table(asked.where("q.to > q.from").select("doc", "sig", "at", "q.*"), "sub-asked")
    wanted = asked.select(F.col("td").alias("wd"), F.col("ts").alias("ws")).distinct()
    texts = df.select(F.col(id_col).alias("xd"), F.xxhash64(F.col(text_col)).alias("xs"), F.col(text_col).alias("x"))
    texts = texts.join(small_or_shuffled(wanted), F.col("xd").eqNullSafe(F.col("wd")) & (F.col("xs") == F.col("ws")), "left_semi")
    # A text that many spans refer to is read by many rows: its join is split by adaptive execution.
    met = asked.join(texts.dropDuplicates(["xd", "xs"]).hint("merge"), F.col("td").eqNullSafe(F.col("xd")) & (F.col("ts") == F.col("xs")))
    piece = F.expr("substring(x, `from` + 1, `to` - `from`)")
    got = met.select("doc", "sig", "at", "side", piece.alias("piece")).groupBy("doc", "sig", "at").agg(
        *[F.max(F.when(F.col("side") == s, F.col("piece"))).alias(s) for s in ("ol", "kl", "or", "kr")])
    got = got.select(F.col("doc").alias("gd"), F.col("sig").alias("gs"), F.col("at").alias("ga"), "ol", "kl", "or", "kr")
    return runs.join(got, F.col("doc").eqNullSafe(F.col("gd")) & (F.col("sig") == F.col("gs")) & (F.col("a.start") == F.col("ga")), "left")


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed span: doc_id, sig, start, end, n_words, n_units, keep_ids."""
    runs = shared_table(runs_of(repeats(df, id_col, text_col), min_words), "sub-runs")
    left = F.pandas_udf(lambda o, k: _extension(o, k, True), "words int, chars int")("ol", "kl")
    right = F.pandas_udf(lambda o, k: _extension(o, k, False), "words int, chars int")("or", "kr")
    wide = _beside(runs, df, id_col, text_col).withColumn("l", left).withColumn("r", right)
    out = wide.select(
        F.col("doc").alias("doc_id"), "sig", (F.col("a.start") - F.col("l.chars")).cast("long").alias("start"),
        (F.col("z.stop") + F.col("r.chars")).cast("long").alias("end"),
        (F.col("n_words") + F.col("l.words") + F.col("r.words")).alias("n_words"), "n_units", "keep_ids")
    out = out.where(F.col("n_words") >= min_words)
    # Spans on both sides of one unit may both reach into it: the later one begins where the first ends.
    earlier = F.max("end").over(Window.partitionBy("doc_id", "sig").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("start", F.greatest("start", earlier))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed span: doc_id, start, end, n_words, n_units (whole ones), keep_ids (ids that
    keep them)."""
    return spans(df, id_col, text_col, min_words).drop("sig")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of ``df`` with the spans cut out of the text, plus ``kept_offsets``: the
    [start, end) pieces of the original text that the cleaned text is made of, in order."""
    d, s, g = fresh(df, "sub_doc"), fresh(df, "sub_sig"), fresh(df, "sub_gone")
    gone = spans(df, id_col, text_col, min_words).groupBy("doc_id", "sig").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("gone"))
    gone = shared_table(gone, "sub-gone").toDF(d, s, g)
    joined = df.join(small_or_shuffled(gone, bound=100_000), F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(F.col(text_col)) == F.col(s)), "left")

    def cut(texts: pd.Series, gones: pd.Series) -> pd.DataFrame:
        out, offsets = [], []
        for t, spans_ in zip(texts, gones, strict=True):
            at, pieces = 0, []
            cuts = [] if spans_ is None or t is None else [(int(x["start"]), int(x["end"])) for x in spans_]
            for a, b in [*cuts, (len(t) if t is not None else 0, None)]:
                if a > at:
                    pieces.append((at, a))
                at = b if b is not None else at
            out.append(None if t is None else "".join(t[a:b] for a, b in pieces))
            offsets.append([{"start": a, "end": b} for a, b in pieces])
        return pd.DataFrame({"text": out, "kept": offsets})

    made = fresh(df, "sub_made")
    result = joined.withColumn(made, F.pandas_udf(cut, "text string, kept array<struct<start:long,end:long>>")(F.col(text_col), F.col(g)))
    cols = [F.col(f"{made}.text").alias(c) if c == text_col else F.col(c) for c in df.columns]
    name = "kept_offsets" if "kept_offsets" not in {c.lower() for c in df.columns} else fresh(df, "kept_offsets")
    return result.select(*cols, F.col(f"{made}.kept").alias(name))
