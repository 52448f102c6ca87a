"""Spelling variants: words one edit away, found with a bit-sliced position index.

Occurrences are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased. Let h be the unsigned
CRC-32 of ``<id>:<run>`` in UTF-8; where ``noise`` divides h the run loses its code point h % length.
The vocabulary holds the results of at least ``min_chars`` code points and ``min_count`` occurrences.

The vocabulary is cut by length into blocks. A block's index has one bit set over its words for
every (position, letter). A query word is read letter by letter against the index, all words of
the block at once, with two sets: Z, the words that agree with every letter so far, and O, those
that agree but for one error. With letters at position j of the index as ``B[j]``:

* same length:     O = (O & B[j][c]) | (Z & ~B[j][c]);                Z = Z & B[j][c]
* one letter more: O = (O | Z) & B[j+1][c]  (the word's letter j is skipped); at the end O | Z
* one letter less: O = (O & B[j-1][c]) | Z  (the query's letter j is skipped); at the end O

Queries are read in sorted order, so that the sets of a shared prefix are computed once. A block
meets the query words of its own length and of one letter more or less, slice by slice; a task
returns one row per query word (near words counted, the most frequent kept), never the pairs.

Defined results: null texts have no runs; a null id reads as an empty string in ``<id>:<run>``;
repeated rows count their runs again (with the same h); a run that loses a letter may become a
word that other runs spell out; ties of n go to the smallest word in code-point order; an empty
table gives an empty vocabulary; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgsift.llm._common import drop_shared, shared_table, small_or_shuffled

NOISE, MIN_CHARS, MIN_COUNT, FACTOR = 199, 6, 5, 5
#: Words of a block times its letters, and of a slice of queries: what one task holds of each.
BLOCK_LETTERS, BLOCK_WORDS, SLICE_WORDS = 1 << 23, 1 << 16, 1 << 14
#: Distinct words that a task sums up before it passes them on.
HELD_WORDS = 200_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def runs_of(doc_id, text: str, pattern: re.Pattern, noise: int, min_chars: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one row; equal runs of a row have equal h, so each is hashed once."""
    lowered: Counter[str] = Counter()
    for run, n in Counter(pattern.findall(text)).items():
        lowered[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    head = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in lowered.items():
        h = crc32(word.encode(), head)
        if h % noise == 0:
            cut = h % len(word)
            word = word[:cut] + word[cut + 1:]
            if len(word) < min_chars:
                continue
        yield word, n


def vocabulary(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE,
               min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n, len): counted per task first, so a word of every text is a few rows per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_chars)  # runs of fewer letters cannot become words
        held: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for word, n in runs_of(doc_id.as_py(), text.as_py(), pattern, noise, min_chars):
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield out()
                    held = {}
        yield out()

    rows = documents.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t")).where(F.col("t").isNotNull())
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count).withColumn("len", F.length("word"))


class BlockIndex:
    """Bit sets over words of one length: ``bits[j][c]`` holds the words with letter c at position j."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words, self.counts = [words[i] for i in order], [counts[i] for i in order]
        self.length = len(words[0])
        self.none = np.zeros((len(words) + 63) // 64, np.uint64)
        self.all = self._set(np.arange(len(words)))
        letters = np.array(self.words, f"<U{self.length}").view(np.uint32).reshape(len(words), self.length)
        self.bits = []
        for j in range(self.length):
            by = np.argsort(letters[:, j], kind="stable")
            values, starts = np.unique(letters[by, j], return_index=True)
            self.bits.append({chr(c): self._set(rows) for c, rows in zip(values, np.split(by, starts[1:]), strict=True)})

    def _set(self, rows: np.ndarray) -> np.ndarray:
        out = self.none.copy()
        np.bitwise_or.at(out, rows >> 6, np.uint64(1) << (rows & 63).astype(np.uint64))
        return out

    def near(self, queries: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(query, rows) for sorted queries of one length; rows are those exactly one edit away."""
        longer = self.length - len(queries[0])
        sets = [(self.all, self.none)]
        past = ""
        for q in queries:
            same = 0
            for a, b in zip(past, q, strict=False):
                if a != b:
                    break
                same += 1
            # A prefix that no word is within one error of ends the sets early.
            del sets[min(same, len(sets) - 1) + 1:]
            zero, one = sets[-1]
            for j in range(len(sets) - 1, len(q)):
                zero, one = self._step(zero, one, j, q[j], longer)
                if zero is None:
                    break
                sets.append((zero, one))
            past = q
            if len(sets) == len(q) + 1:
                rows = self._rows(zero | one if longer == 1 else one)
                if rows:
                    yield q, rows

    def _step(self, zero, one, j, c, longer):
        here = self.bits[j].get(c) if j < self.length else None
        if longer == 0:
            if here is None:
                one, zero = zero, self.none
            else:
                one, zero = (one & here) | (zero & ~here), zero & here
        elif longer == 1:
            after = self.bits[j + 1].get(c)
            one = self.none if after is None else (one | zero) & after
            zero = self.none if here is None else zero & here
        else:
            before = self.bits[j - 1].get(c) if j else None
            one = zero if before is None else (one & before) | zero
            zero = self.none if here is None else zero & here
        return (zero, one) if one.any() or zero.any() else (None, None)

    @staticmethod
    def _rows(found: np.ndarray) -> list[int]:
        rows = []
        for i in np.flatnonzero(found).tolist():
            bits = int(found[i])
            while bits:
                low = bits & -bits
                rows.append(i * 64 + low.bit_length() - 1)
                bits ^= low
        return rows


def _near_of_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for queries, words in zip(batch.column(0), batch.column(1), strict=True):
            q, w = queries.values, words.values
            index = BlockIndex(w.field(0).to_pylist(), w.field(1).to_pylist())
            out = []
            for word, rows in index.near(sorted(q.to_pylist())):
                best = max(rows, key=lambda i: (index.counts[i], -i))
                out.append((word, len(rows), index.counts[best], index.words[best]))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "near", "best_n", "best"])


def near_words(words: DataFrame, block_letters: int = BLOCK_LETTERS, block_words: int = BLOCK_WORDS,
               slice_words: int = SLICE_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n, len) that have near words."""
    sizes = words.groupBy("len").agg(F.count(F.lit(1)).alias("size"))
    sizes = shared_table(sizes.select(F.col("len").alias("sl"), "size"), "spell-sizes")  # one row per length
    cut = words.join(small_or_shuffled(sizes), F.col("len") == F.col("sl"))

    def room_of(length: str):
        return F.greatest(F.least(F.lit(block_words), F.floor(F.lit(block_letters) / F.col(length))), F.lit(1))

    room = room_of("len")
    key = F.xxhash64("word")
    blocks = cut.groupBy("len", F.pmod(key, F.ceil(F.col("size") / room)).alias("part")).agg(
        F.collect_list(F.struct("word", "n")).alias("words"))
    slices = cut.groupBy("len", F.pmod(key, F.ceil(F.col("size") / F.least(room, F.lit(slice_words)))).alias("slice")).agg(
        F.collect_list("word").alias("queries"))
    targets = F.explode(F.array(*[F.col("len") + d for d in (-1, 0, 1)])).alias("target")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / room_of("sl")) - 1)).alias("to")
    met = slices.select(targets, "queries").join(small_or_shuffled(sizes), F.col("target") == F.col("sl"))
    met = met.select("target", parts, "queries")
    units = met.join(shared_table(blocks, "spell-blocks").hint("merge"), (F.col("target") == F.col("len")) & (F.col("to") == F.col("part")))
    units = units.select("queries", "words")
    units = shared_table(units, "spell-units")
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), units.count() // 8)
    near = units.repartition(tasks).mapInArrow(_near_of_units, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best"))).alias("b")
    return near.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(rw, root) of (word, form): the last form. Each form is at least ``factor`` times as frequent, so
    chains are as long as the logarithm of the largest count, and pointer doubling halves them."""
    now = shared_table(forms.select(F.col("word").alias("rw"), F.col("form").alias("root")), "spell-roots")
    while True:
        ahead = now.select(F.col("rw").alias("aw"), F.col("root").alias("next"))
        step = now.join(small_or_shuffled(ahead), F.col("root") == F.col("aw"), "left")
        new = shared_table(step.select("rw", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spell-roots")
        drop_shared(now)
        if not new.where("moved").limit(1).count():
            return new.drop("moved")
        moved, now = new, new.drop("moved")
        now._shared_path = moved._shared_path


def variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE, min_chars: int = MIN_CHARS,
             min_count: int = MIN_COUNT, factor: int = FACTOR, **blocks: int) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n. ``form`` is the most frequent near word if
    it is at least ``factor`` times as frequent, ``root`` the end of the chain of forms."""
    words = shared_table(vocabulary(documents, id_col, text_col, noise, min_chars, min_count), "spell-words")
    near = near_words(words, **blocks).select(F.col("word").alias("nw"), "n_near", "best_n", "best")
    joined = words.join(near, F.col("word") == F.col("nw"), "left")
    better = F.col("best_n") >= F.lit(factor) * F.col("n")
    joined = shared_table(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(better, F.col("best")).alias("form"),
        F.when(better, F.col("best_n")).alias("form_n")), "spell-forms")
    ends = roots(joined.where(F.col("form").isNotNull()))
    out = joined.join(small_or_shuffled(ends), F.col("word") == F.col("rw"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
