"""Hashed token features and bounded labelled samples for the text classifiers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Byte classes: 0 white space and control, 1 word (letters, digits, underscore, all of non-ASCII), 2 punctuation.
_BYTES = np.arange(256)
_CLASS = np.where(_BYTES < 33, 0, 2).astype(np.int8)
_CLASS[[i for i in range(256) if i >= 128 or chr(i).isalnum() or chr(i) == "_"]] = 1
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64) + np.uint64(1)
_UPPER_CASE = ((_BYTES >= 65) & (_BYTES <= 90)).astype(np.int32)
_LOWER_CASE = (((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)).astype(np.int32)
_DIGIT = ((_BYTES >= 48) & (_BYTES <= 57)).astype(np.int32)
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, shape class) of every token of the whole text, computed on its bytes at once.

    A token is a run of word bytes or of punctuation; the hash ignores ASCII case. Shape classes:
    1 digits, 2 upper case, 3 one capital, 4 capitalised, 5 lower case, 6 mixed; 8 to 63 are
    punctuation runs by hash.
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8) if text else np.empty(0, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    kind = _CLASS[raw]
    bounds = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    sizes = np.diff(np.append(bounds, len(raw)))
    inside = np.arange(len(raw)) - np.repeat(bounds, sizes)
    hashes = np.add.reduceat(_LOWER[raw] * _POWER[inside & 63], bounds)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    first = kind[bounds]
    keep = first > 0
    up, low = np.add.reduceat(_UPPER_CASE[raw], bounds), np.add.reduceat(_LOWER_CASE[raw], bounds)
    digits = np.add.reduceat(_DIGIT[raw], bounds)
    capital = _UPPER_CASE[raw[bounds]] > 0
    shape = np.where(up + low == 0, 1, np.where(low == 0, np.where(up > 1, 2, 3), np.where(
        capital & (up == 1) & (digits == 0), 4, np.where((up == 0) & (digits == 0), 5, 6))))
    shape = np.where(first == 2, 8 + (hashes >> np.uint64(40)).astype(np.int64) % 56, shape)
    return hashes[keep], shape[keep].astype(np.uint64)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _doubled(words: np.ndarray) -> np.ndarray:
    """The bigrams of a word with itself as one class, by the power of two of their share."""
    share = (words[1:] == words[:-1]).sum() / len(words)
    return np.arange(int(np.log2(share * 1024 + 1)), dtype=np.uint64)


def ngram_indicators(text: str | None, bits: int) -> np.ndarray:
    """Distinct hashed n-grams (words: 1 and 2, shape classes: 1 to 3) in ``2**bits`` slots."""
    words, shape = tokens(text)
    if not len(words):
        return np.empty(0, np.int64)
    pairs = shape[:-1] * np.uint64(64) + shape[1:]
    grams = np.concatenate([
        _mix(words, 1), _mix(words[:-1] * np.uint64(3) + _mix(words[1:], 7), 2), _mix(np.unique(shape), 3),
        _mix(np.unique(pairs), 4), _mix(np.unique(pairs[:-1] * np.uint64(64) + shape[2:]), 5),
        _mix(_doubled(words), 6)])
    return np.unique((grams >> np.uint64(64 - bits)).astype(np.int64))


def words_of(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word slots of several one-line texts, one after the other, and each text's number."""
    raw = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    kind = _CLASS[raw] == 1
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    bounds = np.concatenate([[0], edge])
    inside = np.arange(len(raw)) - np.repeat(bounds, np.diff(np.append(bounds, len(raw))))
    keep = kind[bounds]
    hashes = np.add.reduceat(_LOWER[raw] * _POWER[inside & 63], bounds)[keep]
    of = np.searchsorted(np.flatnonzero(raw == 10), bounds[keep])
    return (_mix(hashes, 9) % np.uint64(size)).astype(np.int64), np.bincount(of, minlength=len(texts))


def word_counts(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots, counts) of the hashed words."""
    return np.unique((_mix(tokens(text)[0], 1) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; the folds of the held-out contract (0 is held out)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, text, y): at most ``max_rows`` labelled training ids, chosen by hash order.

    The chosen ids are the only broadcast (``max_rows`` longs), so no text is shuffled. Held-out
    folds are left out; an id labelled twice has the smaller label; null labels are ignored.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != 0))
    ids = ids.groupBy(F.col(id_col).alias("i")).agg(F.min(F.col(label).cast("int")).alias("y"))
    chosen = ids.orderBy(F.xxhash64(F.col("i").cast("string")), "i").limit(max_rows)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.join(F.broadcast(chosen), F.col("id") == F.col("i")).select("id", "text", "y")


def collected(sample: DataFrame, pack: Callable[[str | None], tuple[bytes, bytes]]) -> list[tuple[int, bytes, bytes]]:
    """(label, packed features) of a bounded sample on the driver, in an order that no plan changes.

    Features travel as packed numbers: a few kilobytes a row, and no Python object per number.
    """
    def run(batches):
        for b in batches:
            packed = [pack(t) for t in b["text"]]
            yield pd.DataFrame({"y": b["y"], "x": [x for x, _ in packed], "k": [k for _, k in packed]})

    rows = sample.select("text", "y").mapInPandas(run, "y int, x binary, k binary").collect()
    return sorted((int(r["y"]), bytes(r["x"]), bytes(r["k"])) for r in rows)
