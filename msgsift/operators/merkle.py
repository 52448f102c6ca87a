"""A stored digest tree over a corpus, and the descent that finds where two corpora differ.

A row's digest is the SHA-256 of its label and text (``row_digests``). A leaf holds the rows whose
digests share their first ``DEPTH`` hex digits; its digest covers the sorted row digests with their
counts. A node one digit shorter covers its children, up to the root with the empty prefix. The
tree is a table (level, prefix, rows, digest), stored by level, so comparing two trees reads only
the children of nodes that differ: equal corpora read one row each, one changed row at most
1 + 16 x DEPTH.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgsift.session import cut_lineage

#: Hex digits of a leaf: 65,536 leaves.
DEPTH = 4


def row_digests(df: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """The columns of ``df`` and ``h``: the SHA-256 of its two fields, each with its length in bytes and a
    mark for null, so no two different rows share an encoding."""

    def field(c: str) -> F.Column:
        v = F.col(c).cast("string")
        return F.when(v.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.octet_length(v).cast("string"), F.lit(":"), v))

    return df.withColumn("h", F.sha2(F.concat(field(label_col), field(text_col)).cast("binary"), 256))


def leaf_digests(df: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """(prefix, rows, digest) of the leaves: distinct row digests with their counts, sorted and hashed."""
    each = row_digests(df, label_col, text_col).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    leaf = each.groupBy(F.substring("h", 1, DEPTH).alias("prefix")).agg(
        F.sum("n").alias("rows"), F.sort_array(F.collect_list(F.concat_ws("*", "h", "n"))).alias("x"))
    return leaf.select("prefix", "rows", F.sha2(F.array_join("x", ",").cast("binary"), 256).alias("digest"))


def digest_tree(df: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """(level, prefix, rows, digest) of all nodes; level 0 is the root. An empty corpus has a root only."""
    level = cut_lineage(leaf_digests(df, label_col, text_col))
    tree = level.select(F.lit(DEPTH).alias("level"), "prefix", "rows", "digest")
    for depth in range(DEPTH - 1, -1, -1):
        # At most 16 children.
        child = F.concat_ws(":", "prefix", "digest")
        up = level.groupBy(F.substring("prefix", 1, depth).alias("p")) if depth else level.groupBy()
        level = up.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"), F.sha2(F.array_join(F.sort_array(
            F.collect_list(child)), ",").cast("binary"), 256).alias("digest"))
        level = level.select(F.col("p").alias("prefix") if depth else F.lit("").alias("prefix"), "rows", "digest")
        tree = tree.unionByName(level.select(F.lit(depth).alias("level"), "prefix", "rows", "digest"))
    return tree


def write_tree(tree: DataFrame, path: str) -> None:
    tree.repartition("level").write.mode("overwrite").partitionBy("level").parquet(path)


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    """The nodes of a level with the prefix ``u`` of their parent; no nodes below the root of an empty corpus."""
    nodes = spark.read.schema("prefix string, rows long, digest string, level int").parquet(path).where(F.col("level") == level)
    return nodes.drop("level").withColumn("u", F.expr(f"left(prefix, {max(level - 1, 0)})"))


def differing_leaves(spark: SparkSession, one: str, other: str) -> DataFrame:
    """(prefix, rows, other_rows) of the leaves in which two stored trees differ.

    The descent reads one level after the other, and of a level only the children of the nodes that
    differed above (their prefixes are a filter on the sorted files).
    """
    differ = spark.createDataFrame([("",)], "up string")
    for level in range(DEPTH + 1):
        a, b = (_level(spark, p, level).join(F.broadcast(differ), F.col("u") == F.col("up"), "left_semi") for p in (one, other))
        met = a.drop("u").join(b.select(F.col("prefix").alias("bp"), F.col("rows").alias("other_rows"), F.col("digest").alias("bd")), F.col("prefix") == F.col("bp"), "full")
        met = met.where(~F.col("digest").eqNullSafe(F.col("bd"))).select(
            F.coalesce("prefix", "bp").alias("prefix"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.coalesce("other_rows", F.lit(0).cast("long")).alias("other_rows"))
        met = cut_lineage(met)
        if met.isEmpty():
            return met.limit(0)
        differ = met.select(F.col("prefix").alias("up"))
    return met


def rows_in(df: DataFrame, leaves: DataFrame, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that lie in the given leaves, with their digest ``h``."""
    keyed = row_digests(df, label_col, text_col)
    return keyed.join(leaves.select(F.col("prefix").alias("_leaf")), F.substring("h", 1, DEPTH) == F.col("_leaf"), "left_semi")
