"""Exact deduplication through an extendible-hash index kept on shared files.

Every text is normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space; null is the
empty text) and gets a 64-bit hash ``h`` and its SHA-256. One pass writes the entries
(id, h, sha256), without texts, to the shared folder. Entries are first collapsed per
(h, sha256), so a text with any number of copies is one index record.

The directory is a table of slots: the leading ``depth`` bits of ``h`` point to a bucket.
While a bucket holds more than ``capacity`` digests the directory doubles: only the
overfull buckets split on the next bit, the others keep their local depth. A running sum over
the directory cuts the key range at bucket bounds into owners of about equal size, so a bucket
is never divided. Each owner task gets the records of its whole buckets (at most ``SALTS`` per
digest, however many copies there are) and builds the chains: inside a bucket, the records that
share ``h``. Size and survivor of a group come from its chain. The owners write the index, sorted
by bucket and chain, to the shared folder.

Bytes decide: the texts of every chain that stands for more than one row go, one for each
different text of a digest (copies meet before the shuffle), to the owner of the chain, which
counts the different texts behind each digest.

Defined results: a null text equals the empty text; a null id is larger than any id; rows
that repeat an id and a text count as members, and exactly one of them is kept; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgsift.llm._common import shared_table, small_or_shuffled

#: ASCII white space of the contract.
SPACE = r"[ \t-\r]+"
MAX_DEPTH = 48
#: Digests of one bucket, depth of the first directory, and records that the copies of a text are folded into.
CAPACITY, INITIAL_DEPTH, SALTS = 8192, 4, 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def prefix(h: Column, depth: int | Column) -> Column:
    """The leading ``depth`` bits of a 64-bit hash (depth >= 1)."""
    if isinstance(depth, int):
        return F.shiftrightunsigned(h, 64 - depth)
    return F.expr(f"shiftrightunsigned(h, cast(64 - {depth} as int))")


def build_directory(digests: DataFrame, capacity: int, initial_depth: int) -> DataFrame:
    """The buckets (depth, slot, n): leaves of the split tree over the leading bits of ``h``.

    ``digests`` has one row per distinct (h, sha256). The loop ends at the first level with
    no overfull bucket; a level costs one aggregation of the digests that are still in
    overfull buckets, and levels grow with log2(digests / capacity).
    """
    records = digests
    depth = initial_depth
    level = records.groupBy(prefix(F.col("h"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    level = shared_table(level.select(F.lit(depth).alias("depth"), "slot", "n"), "exact-directory")
    leaves = level.where((F.col("n") <= capacity))
    over = level.where(F.col("n") > capacity)
    while depth < MAX_DEPTH:
        n_over = over.count()
        if n_over == 0:
            return leaves
        depth += 1
        parents = small_or_shuffled(over.select(F.col("slot").alias("parent")), n_over)
        split = records.select("h", prefix(F.col("h"), depth - 1).alias("up")).join(
            parents, F.col("up") == F.col("parent"))
        level = split.groupBy(prefix(F.col("h"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        level = shared_table(level.select(F.lit(depth).alias("depth"), "slot", "n"), "exact-directory")
        leaves = leaves.unionByName(level.where(F.col("n") <= capacity))
        over = level.where(F.col("n") > capacity)
    return leaves.unionByName(over)


def owners(leaves: DataFrame, parts: int) -> DataFrame:
    """The directory with the owner of each bucket: whole buckets in key order, about equally many
    digests for each of ``parts`` owners. The running sum is over one row per bucket."""
    first = F.expr("shiftleft(slot, cast(63 - depth as int))")  # the unsigned order of h, without its last bit
    total = leaves.agg(F.sum("n")).first()[0] or 1
    before = F.sum("n").over(Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1))
    return leaves.withColumn("owner", F.floor(F.coalesce(before, F.lit(0)) * parts / F.lit(total)).cast("int"))


def place(records: DataFrame, directory: DataFrame) -> DataFrame:
    """Give each record its bucket and owner: one equi-join per local depth in use (at most 48)."""
    depths = [r["depth"] for r in directory.select("depth").distinct().collect()]
    placed = None
    for d in sorted(depths):
        here = directory.where(F.col("depth") == d).select(F.col("slot").alias("s"), "owner")
        part = records.withColumn("s", prefix(F.col("h"), d)).join(
            small_or_shuffled(here), "s").withColumn("depth", F.lit(d)).withColumnRenamed("s", "slot")
        placed = part if placed is None else placed.unionByName(part)
    if placed is None:
        return records.withColumn("slot", F.lit(0).cast("long")).withColumn("owner", F.lit(0)).withColumn("depth", F.lit(0))
    return placed


def build_index(df: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY,
                initial_depth: int = INITIAL_DEPTH) -> tuple[DataFrame, DataFrame]:
    """(entries, index): entries (id, h, sha, copies) and the chains on shared files.

    An index row is (owner, depth, slot, h, sha, n, keep, chain): ``n`` rows have this digest, ``keep``
    is the smallest id among them, and the chain of ``h`` stands for ``chain`` rows.
    """
    norm = normalised(F.col(text_col))
    base = df.select(F.col(id_col).alias("id"), norm.alias("t"))
    rows = base.select("id", F.xxhash64("t").alias("h"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha"))
    entries = shared_table(
        rows.groupBy("h", "sha", "id").agg(F.count(F.lit(1)).alias("copies")), "exact-entries")
    # Copies of one text are folded into a bounded number of records before they meet at the owner.
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    records = shared_table(entries.groupBy("h", "sha", salt.alias("salt")).agg(
        F.sum("copies").alias("n"), F.min("id").alias("keep")), "exact-records")
    digests = shared_table(records.select("h", "sha").distinct(), "exact-digests")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    directory = shared_table(owners(build_directory(digests, capacity, initial_depth), parts), "exact-owners")
    owned = place(records, directory).repartition(parts, "owner")
    # Both steps run inside the owner's task: its rows are not moved again.
    nodes = owned.groupBy("owner", "depth", "slot", "h", "sha").agg(F.sum("n").alias("n"), F.min("keep").alias("keep"))
    chains = nodes.withColumn("chain", F.sum("n").over(Window.partitionBy("owner", "depth", "slot", "h")))
    order = F.expr("shiftleft(slot, cast(63 - depth as int))")
    return entries, shared_table(chains.sortWithinPartitions(order, "h"), "exact-index")


def compare_bytes(df: DataFrame, text_col: str, index: DataFrame) -> DataFrame:
    """(h, sha, texts): how many different texts hide behind each digest of a chain.

    Only texts whose chain stands for more than one row take part. They are folded by their whole
    bytes, on the map side first, and what is left meets at the owner of the chain.
    """
    chains = index.where(F.col("chain") > 1).groupBy("h").agg(F.min("owner").alias("owner"))
    chains = shared_table(chains.select(F.col("h").alias("ch"), "owner"), "exact-chains")
    texts = df.select(normalised(F.col(text_col)).alias("t")).withColumn("h", F.xxhash64("t"))
    texts = texts.join(small_or_shuffled(chains), F.col("h") == F.col("ch"))
    texts = texts.withColumn("sha", F.unhex(F.sha2(F.col("t").cast("binary"), 256)))
    different = texts.groupBy("owner", "h", "sha", "t").agg(F.count(F.lit(1)).alias("c"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return different.repartition(parts, "owner").groupBy("owner", "h", "sha").agg(F.count("t").alias("texts"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, initial_depth: int = INITIAL_DEPTH) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays. Equality is decided by the compared
    bytes: a digest that stands for several texts (never seen, but not ruled out) is resolved
    by grouping its rows on the text itself.
    """
    entries, index = build_index(df, id_col, text_col, capacity, initial_depth)
    nodes = shared_table(compare_bytes(df, text_col, index), "exact-nodes")
    clashes = nodes.where(F.col("texts") > 1).select("h", "sha")
    n_clash = clashes.count()
    groups = index.where(F.col("n") > 1).select(
        F.col("h").alias("gh"), F.col("sha").alias("gs"), F.col("n").alias("gn"), F.col("keep").alias("gk"))
    joined = entries.join(small_or_shuffled(groups), (F.col("h") == F.col("gh")) & (F.col("sha") == F.col("gs")), "left")
    plain = joined.select(
        "id", "copies", "sha",
        F.when(F.col("gn").isNull(), F.col("id")).otherwise(F.col("gk")).alias("keep"),
        F.coalesce("gn", F.lit(1).cast("long")).alias("n"), "h")
    out = _members(plain if n_clash == 0 else plain.join(clashes, ["h", "sha"], "left_anti"))
    if n_clash:
        rows = df.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
        rows = rows.withColumn("h", F.xxhash64("t")).withColumn("sha", F.unhex(F.sha2(F.col("t").cast("binary"), 256)))
        rows = rows.join(clashes, ["h", "sha"], "left_semi")
        per_id = rows.groupBy("h", "sha", "t", "id").agg(F.count(F.lit(1)).alias("copies"))
        per_text = per_id.groupBy(F.col("t").alias("gt")).agg(F.sum("copies").alias("n"), F.min("id").alias("keep"))
        out = out.unionByName(_members(per_id.join(per_text, F.col("t") == F.col("gt"))))
    return out


def _members(rows: DataFrame) -> DataFrame:
    """Repeat (id, text) rows as often as they occur; the first of the kept id stays."""
    each = rows.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        F.col("id").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep")) & (F.col("i") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
