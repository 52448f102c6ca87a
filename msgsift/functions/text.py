"""Text scalar functions as Spark column expressions.

Everything here returns a ``Column`` so it composes into one projection and stays
inside the JVM, ``strip_accents`` too: its NFKD decomposition is a static method of the
ICU library that Spark ships.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the analysed pipeline's definitions for equal results)
# ---------------------------------------------------------------------------

# Word tokens for corpus statistics: lower-case ASCII letters/digits with one
# optional inner apostrophe part.
TOKEN_PATTERN = "[a-z0-9]+(?:'[a-z0-9]+)?"

# Default English stopword list used by the corpus statistics (63 words).
DEFAULT_STOPWORDS = (
    "a", "about", "after", "all", "am", "an", "and", "are", "as", "at",
    "be", "because", "been", "but", "by", "can", "do", "for", "from", "had",
    "has", "have", "he", "her", "him", "his", "i", "if", "in", "is",
    "it", "its", "just", "me", "my", "no", "not", "of", "on", "or",
    "our", "she", "so", "that", "the", "their", "them", "then", "there", "they",
    "this", "to", "was", "we", "were", "what", "when", "where", "who", "will",
    "with", "you", "your",
)

# Characters Python's ``str.strip()`` removes (``str.isspace()``), written out so
# the same class works in Java regex (Spark) and RE2 (DuckDB oracle).
WHITESPACE_CLASS = (
    "\\t\\n\\x{0b}\\x{0c}\\r\\x{1c}\\x{1d}\\x{1e}\\x{1f} \\x{85}\\x{a0}\\x{1680}"
    "\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)

# Feature tokens: a Unicode word character (letter, number, underscore) followed by
# word characters or apostrophes, never ending in an apostrophe. Equivalent to
# ``\b\w[\w']*\b`` with Python's Unicode ``\w`` and needs no look-behind, so it runs
# unchanged in Java regex and RE2.
_WORD = "[\\p{L}\\p{N}_]"
WORD_PATTERN = f"{_WORD}(?:[\\p{{L}}\\p{{N}}_']*{_WORD})?"

#: The same characters as a string, for trimming without a regular expression.
WHITESPACE = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                      0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()`` semantics (all Unicode whitespace), unlike Spark ``trim``."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def normalize_text(c: Column | str, *, lowercase: bool = True) -> Column:
    """null -> "", Unicode strip, optional lower-casing."""
    out = strip_ws(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.lower(out) if lowercase else out


def filter_tokens(
    tokens: Column | str,
    *,
    min_token_length: int = 1,
    filter_numeric_only: bool = True,
    remove_stopwords: bool = False,
    stopwords: Iterable[str] = DEFAULT_STOPWORDS,
) -> Column:
    """Drop short tokens, then all-digit tokens, then stopwords (in that order)."""
    if min_token_length < 1:
        raise ValueError(f"min_token_length is {min_token_length}; tokens have 1 or more characters")
    stop = sorted({w.lower() for w in stopwords}) if remove_stopwords else []
    stop_arr = F.array(*[F.lit(w) for w in stop]).cast("array<string>") if stop else None

    def keep(t: Column) -> Column:
        cond = F.length(t) >= F.lit(min_token_length)
        if filter_numeric_only:
            # Only what sorts below ":" can begin with a digit; the others need no regular expression.
            cond = cond & ~((t < F.lit(":")) & t.rlike("^[0-9]+$"))
        if stop_arr is not None:
            cond = cond & ~F.array_contains(stop_arr, t)
        return cond

    return F.filter(_col(tokens), keep)


def tokenize(
    c: Column | str,
    *,
    lowercase: bool = True,
    remove_stopwords: bool = False,
    min_token_length: int = 1,
    filter_numeric_only: bool = True,
    stopwords: Iterable[str] = DEFAULT_STOPWORDS,
) -> Column:
    """Ordered word tokens of one message (duplicates kept).

    With ``lowercase=False`` upper-case letters never match the pattern and act as
    separators, exactly as in the analysed pipeline.
    """
    if min_token_length < 1:
        raise ValueError(f"min_token_length is {min_token_length}; tokens have 1 or more characters")
    # Stripping surrounding whitespace cannot change which tokens match, so the
    # tokenizer skips the strip pass (one regex scan per message instead of two).
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    raw = F.regexp_extract_all(F.lower(text) if lowercase else text, F.lit(TOKEN_PATTERN), 0)
    if min_token_length == 1 and not filter_numeric_only and not remove_stopwords:
        return raw
    return filter_tokens(
        raw,
        min_token_length=min_token_length,
        filter_numeric_only=filter_numeric_only,
        remove_stopwords=remove_stopwords,
        stopwords=stopwords,
    )


def stopword_filter(tokens: Column | str, stopwords: Iterable[str] = DEFAULT_STOPWORDS) -> Column:
    """Remove (lower-cased) stopwords from a token array."""
    stop = sorted({w.lower() for w in stopwords})
    arr = F.array(*[F.lit(w) for w in stop]).cast("array<string>")
    return F.filter(_col(tokens), lambda t: ~F.array_contains(arr, t))


def make_ngrams(tokens: Column | str, n: int) -> Column:
    """Space-joined contiguous n-grams; fewer than n tokens -> empty array."""
    if n < 1:
        raise ValueError(f"n is {n}; an n-gram has 1 or more tokens")
    t = _col(tokens)
    grams = t
    for k in range(2, n + 1):
        # A k-gram is a (k-1)-gram and the token k - 1 places after its first.
        left = F.size(t) - F.lit(k - 1)
        grams = F.zip_with(F.slice(grams, 1, left), F.slice(t, k, left), lambda a, b: F.concat_ws(" ", a, b))
    return t if n == 1 else F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


def _combining_class() -> str:
    """All characters with a combining class, as ranges of a Java character class."""
    points = [c for c in range(0x300, sys.maxunicode + 1) if unicodedata.combining(chr(c))]
    starts = [c for c in points if not unicodedata.combining(chr(c - 1))]
    ends = [c for c in points if c == sys.maxunicode or not unicodedata.combining(chr(c + 1))]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True))


#: The first range keeps the many others from being tried on every letter.
_COMBINING_RE = f"[\\x{{300}}-\\x{{10ffff}}&&[{_combining_class()}]]+"


def strip_accents(c: Column | str) -> Column:
    """NFKD decomposition with combining marks removed. Texts of ASCII alone (as many bytes as
    characters) and nulls stay as they are."""
    text = _col(c)
    plain = text.isNull() | (F.octet_length(text) == F.char_length(text))
    decomposed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), text, F.lit(True))
    return F.when(plain, text).otherwise(F.regexp_replace(decomposed, F.lit(_COMBINING_RE), F.lit("")))


def word_analyzer(c: Column | str, *, accents: bool = True) -> Column:
    """Feature tokens: lower-case, strip accents, Unicode word tokens."""
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    if accents:
        text = strip_accents(text)
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), 0)


def ngram_range_terms(
    tokens: Column | str, *, max_n: int = 2, stopwords: Iterable[str] | None = None
) -> Column:
    """Unigrams plus 2..max_n-grams; stopwords (if given) are removed first.

    Pass a column reference: the n-gram lambdas read ``tokens`` once per element, so
    an expression (e.g. a filter) would be re-evaluated per element. With
    ``stopwords`` prefer materialising ``stopword_filter`` as its own column."""
    t = _col(tokens)
    if stopwords is not None:
        t = stopword_filter(t, stopwords)
    parts = [t] + [make_ngrams(t, n) for n in range(2, max_n + 1)]
    return F.concat(*parts) if len(parts) > 1 else t


def occurrences(df: DataFrame, arrays: dict[int, str], keys: Iterable[str] = ()) -> DataFrame:
    """(row_id, *keys, n, one, pos, token): the elements of the array columns ``arrays`` (by their tag n).

    Every element is a row with ``one`` = 1; every different element of a row is once more a row with
    ``one`` = 0, in order of first occurrence. So counts, row counts and first positions come from one
    ``groupBy(token)`` over primitive columns (a hash aggregate with map-side combine), and nothing
    is shuffled per (row, token).
    """
    kinds = [F.struct(F.lit(n).alias("n"), F.lit(one).alias("one"), (F.col(c) if one else F.array_distinct(c)).alias("a"))
             for n, c in arrays.items() for one in (1, 0)]
    # explode_outer: the optimizer would infer a filter on the size of the arrays from explode and
    # compute them once more for it.
    flat = df.select("row_id", *keys, F.explode_outer(F.array(*kinds)).alias("k"))
    return flat.select("row_id", *keys, "k.n", "k.one", F.posexplode("k.a").alias("pos", "token"))


def counted(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """(*keys, count, document_count, first_seen) of ``occurrences``; row ids are unique, and
    ``first_seen`` orders by row and by place among the row's different elements."""
    row = F.when(F.col("one") == 0, F.col("row_id"))
    stats = rows.groupBy(*keys).agg(F.sum("one").alias("count"), F.count(row).alias("document_count"),
                                    F.min(row).alias("_row"), F.min_by("pos", row).alias("_pos"))
    return stats.select(*keys, "count", "document_count", F.struct(F.col("_row").alias("row_id"), F.col("_pos").alias("pos")).alias("first_seen"))


def row_counts(df: DataFrame, terms_col: str, keys: Iterable[str] = ()) -> DataFrame:
    """(row_id, *keys, term, tf) of each row's different terms; a row without terms keeps a null one."""
    each = df.select("row_id", *keys, F.explode_outer(terms_col).alias("term"))
    return each.groupBy("row_id", *keys, "term").agg(F.count("term").alias("tf"))


def counted_in_row(df: DataFrame, terms_col: str) -> DataFrame:
    """(row_id, term, tf) of each row's different terms, counted inside the row: its sorted terms are cut
    where a new one begins, so nothing is shuffled. Rows without terms give nothing; rows that share an
    id are counted apart."""
    rows = df.select("row_id", F.sort_array(terms_col).alias("_s")).where(F.size("_s") > 0)
    begins = F.filter(F.sequence(F.lit(1), F.size("_s")), lambda i: (i == 1) | ~F.element_at("_s", i).eqNullSafe(F.element_at("_s", F.greatest(i - 1, F.lit(1)))))
    rows = rows.withColumn("_b", begins)
    ends = F.concat(F.slice("_b", 2, F.size("_b")), F.array(F.size("_s") + 1))
    runs = F.zip_with("_b", ends, lambda b, e: F.struct(F.element_at("_s", b).alias("term"), (e - b).cast("long").alias("tf")))
    return rows.select("row_id", F.explode_outer(runs).alias("r")).select("row_id", "r.term", "r.tf").where(F.col("term").isNotNull())
