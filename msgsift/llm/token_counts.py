"""Token counts through a digest cache.

A cache is a Parquet folder (version, digest, n_tokens) on shared storage. ``version`` is the
SHA-256 of the tokenizer's file, its library's version and the settings used here; ``digest`` is
the SHA-256 of the normalised content: null as empty text, then the tokenizer's own normaliser,
if it has one. A run

1. writes the digests of all rows (one pass, no text in the shuffle);
2. keeps one row per distinct digest that the cache lacks for this version;
3. encodes those texts only, whole, and appends their counts to the cache;
4. joins every row's digest with the cache.

A byte-level pre-tokenizer never joins a non-space with a following U+0020, so its counts add up
over the pieces between such places (``PIECE``) and a task encodes a piece it has met before only
once. Other tokenizers encode the text as one. Special strings inside a text are handled as the
library's default handles them; nothing is truncated, padded or added.

Defined results: a null text has 0 bytes and 0 tokens; null ids keep their row; repeated rows each
get a row; equal texts, under any ids, are encoded once; an empty table gives an empty result and
appends nothing; extra columns are ignored. A cache folder that does not exist yet is an empty
cache. Counts that two parallel runs appended twice are equal and are read once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.llm._common import BROADCAST_ROWS, shared_table, small_or_shuffled
from msgsift.session import scratch_path

LIMIT = 512
#: From any character up to the next U+0020 that follows a non-space character.
PIECE = re.compile(r"(?s:.)(?:[^ ]+|(?<=[\s᠎]) )*")
#: A worker process remembers the sizes of up to twice so many pieces of at most so many characters.
KNOWN_PIECES, KNOWN_CHARS = 500_000, 64
_CACHE_SCHEMA = "version string, digest binary, n_tokens long"
_loaded: dict[str, Counter] = {}


class Tokenizer:
    """A tokenizer file's bytes and the version digest of its counts."""

    def __init__(self, path: str):
        self.kind = "json" if path.endswith(".json") else "model"
        with open(path, "rb") as f:
            self.blob = f.read()
        if self.kind == "json":
            import tokenizers as library
        else:
            import sentencepiece as library
        facts = f"{self.kind}|{library.__version__}|no added tokens|whole text|".encode()
        self.version = hashlib.sha256(facts + self.blob).hexdigest()

    @property
    def normalises(self) -> bool:
        return self.kind == "model" or Counter(self).normaliser is not None


class Counter:
    """Counts tokens of texts in one process."""

    def __init__(self, tokenizer: Tokenizer):
        # Sizes of the pieces met lately; when full, they become ``before`` and those met again move back.
        self.known: dict[str, int] = {}
        self.before: dict[str, int] = {}
        if tokenizer.kind == "json":
            from tokenizers import Tokenizer as Library
            from tokenizers import pre_tokenizers

            self.lib = Library.from_str(tokenizer.blob.decode())
            self.lib.no_truncation()
            self.lib.no_padding()
            self.normaliser = self.lib.normalizer
            pre = self.lib.pre_tokenizer
            self.by_piece = (self.normaliser is None and isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space
                             and pre.use_regex and not any(" " in t.content or t.lstrip or t.rstrip or t.single_word
                                                           for t in self.lib.get_added_tokens_decoder().values()))
        else:
            from sentencepiece import SentencePieceProcessor

            self.lib = SentencePieceProcessor(model_proto=tokenizer.blob)
            self.normaliser, self.by_piece = None, False
        self.kind = tokenizer.kind

    def encode_sizes(self, texts: list[str]) -> list[int]:
        if self.kind == "json":
            return [len(e) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        return [len(ids) for ids in self.lib.encode(texts, num_threads=1)]

    def normalised(self, text: str) -> str:
        if self.kind == "model":
            return self.lib.normalize(text)
        return self.normaliser.normalize_str(text) if self.normaliser else text

    def count(self, text: str) -> int:
        if not self.by_piece:
            return self.encode_sizes([text])[0]
        if len(self.known) > KNOWN_PIECES:
            self.before, self.known = self.known, {}
        pieces = PIECE.findall(text)
        new = {p for p in pieces if p not in self.known}
        met = [p for p in new if p in self.before]
        self.known.update(zip(met, map(self.before.__getitem__, met), strict=True))
        new = list(new.difference(met))
        self.known.update(zip(new, self.encode_sizes(new), strict=True))
        total = sum(map(self.known.__getitem__, pieces))
        for p in new:
            if len(p) > KNOWN_CHARS:
                del self.known[p]
        return total


def _counter(tokenizer: Tokenizer) -> Counter:
    """This process's counter of the tokenizer; one version at a time is kept."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if tokenizer.version not in _loaded:
        _loaded.clear()
        _loaded[tokenizer.version] = Counter(tokenizer)
    return _loaded[tokenizer.version]


def content_digest(text: Column, tokenizer: Tokenizer) -> Column:
    """SHA-256 (binary) of the normalised content; a native expression if nothing is normalised."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    if tokenizer.normalises:
        def normal(texts: pd.Series) -> pd.Series:
            return texts.map(_counter(tokenizer).normalised)

        body = F.pandas_udf(normal, "string")(body)
    return F.unhex(F.sha2(body.cast("binary"), 256))


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one version, each digest once."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(_CACHE_SCHEMA).parquet(path).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def find_misses(keys: DataFrame, cache: DataFrame) -> DataFrame:
    """(md, rep, rows): the digests of ``keys`` that the cache lacks, each with the smallest id that
    has it and the number of rows with both."""
    by_id = keys.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    distinct = by_id.groupBy("digest").agg(F.min(F.struct("doc_id", "rows")).alias("r"))
    stored = cache.select(F.col("digest").alias("sd"))
    return shared_table(distinct.join(stored, F.col("digest") == F.col("sd"), "left_anti").select(
        F.col("digest").alias("md"), F.col("r.doc_id").alias("rep"), F.col("r.rows").alias("rows")), "tokens-misses")


def texts_of(docs: DataFrame, keys: DataFrame, misses: DataFrame, n_misses: int) -> DataFrame:
    """(digest, body) of the misses, each once.

    Texts stay where they are read as long as either the misses or the rows to leave out are few
    enough to broadcast (counted first); else the rows meet by (id, digest), which spreads copies
    of one text under different ids. Only texts repeated under one id are brought together.
    """
    mine = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("digest") == F.col("md"))
    repeated = shared_table(misses.where(F.col("rows") > 1), "tokens-repeated")
    once = misses.where(F.col("rows") == 1)
    if n_misses <= BROADCAST_ROWS:
        single = docs.join(F.broadcast(once), mine, "left_semi")
    else:
        others = shared_table(keys.join(once.hint("merge"), mine, "left_anti").select(
            F.col("doc_id").alias("od"), F.col("digest").alias("ox")).distinct(), "tokens-others")
        left = F.col("doc_id").eqNullSafe(F.col("od")) & (F.col("digest") == F.col("ox"))
        single = docs.join(small_or_shuffled(others), left, "left_anti")
    rows = single.select("digest", "body")
    n_repeated = repeated.count()
    if n_repeated:
        twins = docs.join(small_or_shuffled(repeated, n_repeated), mine, "left_semi").select("digest", "body")
        rows = rows.unionByName(twins.dropDuplicates(["digest"]))
    return rows


def encode(rows: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(version, digest, n_tokens) of (digest, body) rows."""
    shipped = rows.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shipped.value)
        for batch in batches:
            sizes = [counter.count(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shipped.value.version] * len(sizes), pa.string()), batch.column(0), pa.array(sizes, pa.int64())],
                ["version", "digest", "n_tokens"])

    return rows.mapInArrow(run, _CACHE_SCHEMA)


def token_counts(documents: DataFrame, tokenizer_path: str, cache_path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_tokens, over_limit. Without ``cache_path`` the run starts
    from an empty cache of its own in the shared folder."""
    spark = documents.sparkSession
    tokenizer = Tokenizer(tokenizer_path)
    cache_path = cache_path or scratch_path(spark, "tokens-cache")
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = documents.select(F.col(id_col).alias("doc_id"), body.alias("body"), content_digest(F.col(text_col), tokenizer).alias("digest"))
    keys = shared_table(docs.select("doc_id", "digest", F.octet_length("body").cast("long").alias("n_bytes")), "tokens-keys")
    misses = find_misses(keys, read_cache(spark, cache_path, tokenizer.version))
    n_misses = misses.count()
    if n_misses:
        encode(texts_of(docs, keys, misses, n_misses), tokenizer).write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path, tokenizer.version).select(F.col("digest").alias("cd"), "n_tokens")
    found = shared_table(_wanted(keys, counts), "tokens-found")
    out = keys.join(small_or_shuffled(found), F.col("digest") == F.col("cd"), "left")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _wanted(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """The counts of the digests that ``keys`` has; the rest of a large cache stays out of the join."""
    mine = keys.select(F.col("digest").alias("kd")).distinct()
    return counts.join(mine, F.col("cd") == F.col("kd"), "left_semi")
