"""Column-level functions (text normalisation, tokenisation, labels)."""

from msgsift.functions.labels import LABEL_MAP, normalize_label
from msgsift.functions.text import (
    DEFAULT_STOPWORDS,
    TOKEN_PATTERN,
    WORD_PATTERN,
    filter_tokens,
    counted,
    make_ngrams,
    ngram_range_terms,
    occurrences,
    row_counts,
    normalize_text,
    stopword_filter,
    strip_accents,
    strip_ws,
    tokenize,
    word_analyzer,
)

__all__ = [
    "DEFAULT_STOPWORDS",
    "LABEL_MAP",
    "TOKEN_PATTERN",
    "WORD_PATTERN",
    "filter_tokens",
    "counted",
    "make_ngrams",
    "ngram_range_terms",
    "occurrences",
    "row_counts",
    "normalize_label",
    "normalize_text",
    "stopword_filter",
    "strip_accents",
    "strip_ws",
    "tokenize",
    "word_analyzer",
]
