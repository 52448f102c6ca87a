"""Helpers shared by the operators: shared-folder tables, null-safe joins, prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

from msgsift.session import checkpoint_dir, ship_package

#: A side is broadcast only when it has been written and counted, and holds at most this many rows.
BROADCAST_ROWS = 500_000
#: A side with texts or arrays must also be weighed: all its values together take at most this many bytes.
BROADCAST_BYTES = 64 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage with files that every executor can read, so a lost
    executor never forces the steps before it to run again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def drop_shared(df: DataFrame) -> None:
    """Delete a table made by ``shared_table`` that no later step reads."""
    path = getattr(df, "_shared_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_or_shuffled(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted size is within ``bound``; otherwise leave the join
    to a shuffle, where adaptive execution splits skewed keys."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= bound else df.hint("merge")


def value_bytes(col: Column, kind: DataType) -> Column:
    """Bytes that a value takes in a row, without its slot's padding; null counts 8."""
    if isinstance(kind, ArrayType):
        return F.lit(16) + F.coalesce(F.aggregate(col, F.lit(0).cast("long"), lambda a, x: a + value_bytes(x, kind.elementType)), F.lit(0))
    if isinstance(kind, StructType):
        return sum((value_bytes(col[f.name], f.dataType) for f in kind.fields), F.lit(8).cast("long"))
    if isinstance(kind, (StringType, BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(col), F.lit(0))
    return F.lit(8).cast("long")


def light_or_shuffled(df: DataFrame, bound: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``small_or_shuffled`` for a written table whose rows have no size bound of their own: the hint
    needs at most ``bound`` rows and ``max_bytes`` bytes, both from one pass over the table."""
    weight = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16).cast("long"))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).first()
    return F.broadcast(df) if n <= bound and size <= max_bytes else df.hint("merge")


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in used:
        name = f"_{name}"
    return name


def ranged(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Range-partition ``df`` by ``order`` and freeze the partition number as ``pid``.

    The shared table pins the sampled range bounds: a retried task reads the same rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartitionByRange(parts, *[F.col(c).asc_nulls_last() for c in order])
    return shared_table(out.withColumn("pid", F.spark_partition_id()), name)


def prefix_sum(df: DataFrame, order: list[str], value: str, out: str, name: str) -> DataFrame:
    """Exclusive running sum of ``value`` over the total order ``order``, as column ``out``.

    Ranges are sorted on their own (a window per range); the totals of the ranges before
    come from a table with one row per partition, which is the only broadcast and is
    bounded by the partition count.
    """
    frozen = ranged(df, order, name)
    totals = frozen.groupBy("pid").agg(F.sum(value).alias("t"))
    before = totals.select(
        F.col("pid").alias("p"),
        (F.sum("t").over(Window.orderBy("pid")) - F.col("t")).alias("pid_before"),
    )
    inside = Window.partitionBy("pid").orderBy(*[F.col(c).asc_nulls_last() for c in order]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = frozen.withColumn("run", F.sum(value).over(inside))
    return (
        run.join(F.broadcast(before), run["pid"] == before["p"])
        .withColumn(out, F.col("pid_before") + F.col("run") - F.col(value))
        .drop("pid", "p", "run", "pid_before")
    )
