"""Benchmark decontamination with a distributed positional inverted index.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is
``width`` consecutive words of a benchmark item; a shorter item is one window. The index holds
postings (term, document, position) of the corpus. Test terms are looked up from the rarest:

1. corpus frequencies of the benchmark's terms (one pass, partial aggregation per term);
2. for each window its ``anchors`` rarest terms; postings are stored for those terms only;
3. every posting of the rarest term votes for a start (position - offset); the second posting
   list is offset the same way and intersected by an equi-join on (document, window, start);
4. the survivors are compared with the words of the document, word for word: exact phrases.

Proximity matches (all words of a window within ``span`` consecutive words of a document, in any
order) come from the same postings: two terms of a window, its rarest ones, must have positions
less than ``span`` apart; the surroundings of these candidates are then searched for the others.

Defined results: null texts have no words; an item without words is never found; an item
without an id matches but cannot be named, so it counts no item; repeated items match alike;
rows with equal ids and texts get equal answers, and rows with equal ids but other texts are
judged on their own text; empty tables give empty results or no hits; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgsift.llm._common import fresh, light_or_shuffled, shared_table, small_or_shuffled

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same gaps before A-Z are lower-cased.
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 10
ANCHORS = 2
SPAN = 20


def lowered(text: Column) -> Column:
    """A-Z lower-cased; in a text of one byte per character that is what ``lower`` does."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, UPPER.lower()))


def pieces(text: Column) -> Column:
    """The words, with an empty piece before (after) them if the text starts (ends) with a gap."""
    return F.split(lowered(text), WORD_GAP)


def word_count(text: Column) -> Column:
    """How many words the text has."""
    p = F.split(F.coalesce(text.cast("string"), F.lit("")), RAW_GAP)
    return (F.size(p) - (F.element_at(p, 1) == "").cast("int")
            - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")).cast("long")


def windows(bench: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(win, item, words): distinct word sequences, each with the items it comes from."""
    words = F.filter(pieces(F.col(text_col)), lambda x: x != "")
    items = bench.select(F.col(id_col).cast("string").alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(width - 1), F.lit(1)))
    each = items.select("item", "w", F.explode(starts).alias("s"))
    each = each.select("item", F.slice("w", F.col("s"), F.least(F.lit(width), F.size("w"))).alias("words"))
    return each.distinct().withColumn("win", F.md5(F.array_join("words", " ").cast("binary")))


def document_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, sig, p): rows of equal id and text share a key; ``sig`` tells texts of one id apart."""
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("sig"),
                       pieces(F.col(text_col)).alias("p"))


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, freq): corpus occurrences of the given terms, zero included."""
    words = docs.select(F.explode("p").alias("t"))
    found = words.join(small_or_shuffled(terms), F.col("t") == F.col("term"), "left_semi")
    counts = found.groupBy("t").agg(F.count(F.lit(1)).alias("f"))
    return terms.join(counts, F.col("t") == F.col("term"), "left").select(
        "term", F.coalesce("f", F.lit(0).cast("long")).alias("freq"))


def anchor_terms(wins: DataFrame, freqs: DataFrame, anchors: int) -> DataFrame:
    """(win, a, b): per window its rarest positions as [(freq, offset, term)] and its two rarest
    different terms as [(freq, term)], rarest first.

    Windows with a term that the corpus lacks cannot occur and are left out.
    """
    flat = wins.select("win", F.posexplode("words").alias("offset", "w"))
    rated = flat.join(small_or_shuffled(freqs), F.col("w") == F.col("term"))
    per = rated.groupBy("win").agg(F.sort_array(F.collect_list(F.struct("freq", "offset", "term"))).alias("a"),
                                   F.sort_array(F.collect_set(F.struct("freq", "term"))).alias("b"))
    return per.where(F.col("a")[0]["freq"] > 0).select("win", F.slice("a", 1, anchors).alias("a"), F.slice("b", 1, 2).alias("b"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Positional postings (term, doc, sig, pos) of the given terms, on shared files."""
    flat = docs.select("doc", "sig", F.posexplode("p").alias("pos", "t"))
    hits = flat.join(small_or_shuffled(terms.distinct()), F.col("t") == F.col("term"))
    return shared_table(hits.select("term", "doc", "sig", "pos"), "decon-postings")


def _looked_up(postings: DataFrame, step: DataFrame, *cols: Column) -> DataFrame:
    """The postings of the terms ``at`` of ``step``, as (win, doc, sig, *cols)."""
    return postings.join(small_or_shuffled(step), F.col("term") == F.col("at")).select("win", "doc", "sig", *cols)


def _same(l: str, r: str, *cols: str) -> Column:
    cond = F.col(f"{l}.doc").eqNullSafe(F.col(f"{r}.doc"))
    for c in ("win", "sig", *cols):
        cond = cond & (F.col(f"{l}.{c}") == F.col(f"{r}.{c}"))
    return cond


def intersect(postings: DataFrame, picked: DataFrame, anchors: int) -> DataFrame:
    """(win, doc, sig, start): starts that every looked-up list of the window votes for."""
    found = None
    for k in range(anchors):
        step = picked.where(F.size("a") > k).select("win", F.col("a")[k]["term"].alias("at"), F.col("a")[k]["offset"].alias("off"))
        votes = _looked_up(postings, step, (F.col("pos") - F.col("off")).alias("start")).where(F.col("start") >= 0)
        if found is None:
            found = votes
        else:
            # Windows of fewer words than lists have no k-th list: they pass.
            through = found.join(picked.where(F.size("a") <= k).select("win"), "win", "left_semi")
            found = through.unionByName(found.alias("l").join(votes.alias("r"), _same("l", "r", "start"), "left_semi"))
    return found


def neighbours(postings: DataFrame, picked: DataFrame, span: int) -> DataFrame:
    """(win, doc, sig, start): positions of a window's rarest term with its second one less than
    ``span`` words away. The lists are dealt into blocks of ``span`` words, so the join is one of equal
    keys; a position may come up in several blocks."""
    block = F.floor(F.col("pos") / F.lit(span))
    one = picked.select("win", F.col("b")[0]["term"].alias("at"))
    near = F.explode(F.array(block - 1, block, block + 1)).alias("block")  # of the rarer list
    first = _looked_up(postings, one, F.col("pos").alias("start"), near)
    two = picked.where(F.size("b") > 1).select("win", F.col("b")[1]["term"].alias("at"))
    second = _looked_up(postings, two, F.col("pos").alias("other"), block.alias("block"))
    met = first.alias("l").join(second.alias("r"), _same("l", "r", "block") & (F.abs(F.col("l.start") - F.col("r.other")) < span), "left_semi")
    alone = first.join(picked.where(F.size("b") < 2).select("win"), "win", "left_semi")
    return met.unionByName(alone).drop("block")


def _with_candidates(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents joined to their candidates (cd, cs, c): the slim keys reduce the documents first."""
    keys = texts.select(F.col("cd").alias("kd"), F.col("cs").alias("ks"))
    some = docs.join(small_or_shuffled(keys), F.col("doc").eqNullSafe(F.col("kd")) & (F.col("sig") == F.col("ks")), "left_semi")
    return some.join(texts.hint("merge"), F.col("doc").eqNullSafe(F.col("cd")) & (F.col("sig") == F.col("cs")))


def _within(x: Column, span: int) -> Column:
    """Whether a stretch of ``span`` words that holds position ``start`` has all words of the window.
    Stretches need to be tried from the window's own words only."""
    first = F.greatest(x["start"] - F.lit(span - 1), F.lit(0))
    return F.exists(F.sequence(first, x["start"]), lambda b: F.array_contains(x["words"], F.get("p", b))
                    & (F.size(F.array_except(x["words"], F.slice(F.col("p"), b + 1, span))) == 0))


def found_windows(documents: DataFrame, bench: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = WIDTH, anchors: int = ANCHORS, span: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(found, windows): exact occurrences (win, doc, sig, start, len, near=false), with ``span`` also
    proximity matches (near=true), and the windows' items."""
    items = shared_table(windows(bench, item_id, item_text, width), "decon-windows")
    wins = items.select("win", "words").distinct()
    docs = document_words(documents, doc_id, doc_text)
    freqs = shared_table(term_frequencies(docs, wins.select(F.explode("words").alias("term")).distinct()), "decon-freq")
    picked = shared_table(anchor_terms(wins, freqs, anchors), "decon-picked")
    rare = picked.select(F.explode("a.term").alias("term"))
    if span is not None:
        rare = rare.unionByName(picked.select(F.explode("b.term").alias("term")))
    postings = build_index(docs, rare)
    found = intersect(postings, picked, anchors).withColumn("near", F.lit(False))
    if span is not None:
        found = found.unionByName(neighbours(postings, picked, span).withColumn("near", F.lit(True)))
    # Word-for-word check: the candidates of a document meet its words once. Only documents with
    # candidates take part, so a shuffle moves their words and no others.
    texts = found.join(light_or_shuffled(wins), "win").groupBy("doc", "sig").agg(
        F.collect_set(F.struct("start", "near", "win", "words")).alias("c"))
    texts = shared_table(texts, "decon-check").withColumnRenamed("doc", "cd").withColumnRenamed("sig", "cs")
    met = _with_candidates(docs, texts)

    def right(x):
        exact = F.slice(F.col("p"), x["start"] + 1, F.size(x["words"])) == x["words"]
        return F.when(x["near"], _within(x, span)).otherwise(exact) if span is not None else exact

    good = met.select("doc", "sig", F.explode(F.transform(F.filter("c", right), lambda x: F.struct(
        x["win"].alias("win"), x["start"].alias("start"), F.size(x["words"]).alias("len"), x["near"].alias("near")))).alias("m"))
    return shared_table(good.select("doc", "sig", "m.*").distinct(), "decon-matches"), items


def _covered(spans: str) -> Column:
    """Number of words in the union of [start, start + len) spans, sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end"))

    def add(acc, x):
        stop = (x["start"] + x["len"]).cast("long")
        begin = F.greatest(x["start"].cast("long"), acc["end"])
        return F.struct((acc["n"] + F.greatest(stop - begin, F.lit(0).cast("long"))).alias("n"),
                        F.greatest(stop, acc["end"]).alias("end"))

    return F.aggregate(F.sort_array(F.col(spans)), zero, add, lambda a: a["n"])


def contamination(documents: DataFrame, bench: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
                  anchors: int = ANCHORS, span: int = SPAN) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    n_near, the items with all words of a window within ``span`` words."""
    matches, items = found_windows(documents, bench, doc_id, doc_text, item_id, item_text, width, anchors, span)
    # One row per document: its spans are bounded by its own words.
    exact = F.when(~F.col("near"), F.struct("start", "len"))
    hit = matches.groupBy("doc", "sig").agg(F.collect_set(exact).alias("spans"))
    hit = hit.select("doc", "sig", _covered("spans").alias("n_hit"))
    named = matches.select("doc", "sig", "win", "near").distinct().join(
        small_or_shuffled(items.select("win", "item")), "win").groupBy("doc", "sig").agg(
        F.sort_array(F.collect_set(F.when(~F.col("near"), F.col("item")))).alias("found"),
        F.size(F.collect_set(F.when(F.col("near"), F.col("item")))).alias("n_near"))
    both = hit.alias("h").join(named.alias("n"), F.col("h.doc").eqNullSafe(F.col("n.doc")) & (F.col("h.sig") == F.col("n.sig")))
    result = shared_table(both.select(F.col("h.doc").alias("rd"), F.col("h.sig").alias("rs"), "n_hit", "found", "n_near"), "decon-result")
    docs = documents.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(doc_text)).alias("sig"), word_count(F.col(doc_text)).alias("n_words"))
    joined = docs.join(light_or_shuffled(result), F.col("doc").eqNullSafe(F.col("rd")) & (F.col("sig") == F.col("rs")), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        F.col("doc").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(found, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def drop_contaminated(documents: DataFrame, bench: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
                      anchors: int = ANCHORS) -> DataFrame:
    """The rows of ``documents`` in which no window occurs; same columns."""
    matches, _ = found_windows(documents, bench, doc_id, doc_text, item_id, item_text, width, anchors)
    d, s = fresh(documents, "bad_doc"), fresh(documents, "bad_sig")
    bad = matches.select("doc", "sig").distinct().toDF(d, s)
    return documents.join(small_or_shuffled(bad), F.col(doc_id).eqNullSafe(F.col(d))
                          & (F.xxhash64(F.col(doc_text)) == F.col(s)), "left_anti")


def proximity_matches(documents: DataFrame, bench: DataFrame, span: int = SPAN, doc_id: str = "doc_id",
                      doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
                      width: int = WIDTH) -> DataFrame:
    """(doc_id, item, win): documents with all words of a window inside ``span`` consecutive words."""
    matches, items = found_windows(documents, bench, doc_id, doc_text, item_id, item_text, width, ANCHORS, span)
    return matches.where("near").select(F.col("doc").alias("doc_id"), "win").distinct().join(
        items.select("win", "item").distinct(), "win").select("doc_id", "item", "win").distinct()
