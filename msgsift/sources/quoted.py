"""Quoted delimited files read by many tasks.

A quoted field may hold line breaks, so a byte range of a file cannot tell on its own whether its
first line begins a record. Two passes over the lines settle it:

1. every byte range (split) computes in which state it ends for both cases - it starts between
   records, or inside a quoted field -, a map of two states; the maps are composed along
   each file, which gives the true state at the start of every split (one row per split);
2. every split puts its lines together to records. What it cannot finish, the lines before its
   first record and its last open record, are pieces; pieces of one record are joined by file order.

Records are parsed by ``from_csv`` with the options of the file reader, so values are those of a
``multiLine`` read. A split holds one record at a time, whatever the size of the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from msgsift.session import scratch_path

_RECORD = "file string, block long, pos long, kind int, record binary"
#: Kinds of pass 2: lines before the split's first record, a whole record, a record that is still open.
HEAD, WHOLE, OPEN = 0, 1, 2


def ends_inside(line: bytes, sep: bytes, inside: bool) -> bool:
    """Whether the line ends inside a quoted field, given whether it starts inside one.

    A quote opens a field only at its start; inside, two quotes are one quote and any other ends it.
    """
    at = 0
    if not inside:
        if line[:1] != b'"':
            at = line.find(sep + b'"')
            if at < 0:
                return False
            at += len(sep)
        at += 1
    while True:
        end = line.find(b'"', at)
        while end >= 0 and line[end + 1:end + 2] == b'"':
            end = line.find(b'"', end + 2)
        if end < 0:
            return True
        at = line.find(sep + b'"', end + 1)
        if at < 0:
            return False
        at += len(sep) + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"))


def _split_states(lines: DataFrame, sep: str) -> DataFrame:
    """(file, block, inside): whether a split starts inside a quoted field."""
    mark = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, outside, inside = None, False, True

        def done():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, outside, inside)], ["file", "block", "outside", "inside"])

        for batch in batches:
            for line, file, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (file, block) != now:
                    if now:
                        yield done()
                    now, outside, inside = (file, block), False, True
                if b'"' in line:
                    outside, inside = ends_inside(line, mark, outside), ends_inside(line, mark, inside)
        if now:
            yield done()

    maps = lines.mapInArrow(run, "file string, block long, outside boolean, inside boolean")
    per_file = maps.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "outside", "inside"))).alias("m"))
    start = F.struct(F.array().cast("array<struct<block:bigint,inside:boolean>>").alias("out"), F.lit(False).alias("now"))
    walked = F.aggregate("m", start, lambda acc, x: F.struct(
        F.concat(acc["out"], F.array(F.struct(x["block"].alias("block"), acc["now"].alias("inside")))).alias("out"),
        F.when(acc["now"], x["inside"]).otherwise(x["outside"]).alias("now")), lambda acc: acc["out"])
    return per_file.select("file", F.explode(walked).alias("s")).select("file", "s.block", "s.inside")


def _records(lines: DataFrame, sep: str) -> DataFrame:
    """Rows of ``_RECORD`` from (line, file, block, inside)."""
    mark = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, kind, pos, held = None, False, WHOLE, 0, []
        rows: list[tuple] = []

        def put(k):
            nonlocal pos
            rows.append((*now, pos, k, b"\n".join(held)))
            pos += 1
            held.clear()

        def batch_of():
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [f.split()[0] for f in _RECORD.split(", ")])
            rows.clear()
            return out

        for batch in batches:
            for line, file, block, state in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (file, block) != now:
                    if held:
                        put(HEAD if kind == HEAD else OPEN)
                    now, inside, pos = (file, block), state, 0
                    kind = HEAD if state else WHOLE
                held.append(line)
                inside = ends_inside(line, mark, inside) if inside or b'"' in line else False
                if not inside:
                    put(kind)
                    kind = WHOLE
            yield batch_of()
        if held:
            put(HEAD if kind == HEAD else OPEN)
        yield batch_of()

    return lines.mapInArrow(run, _RECORD)


def quoted_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, block, pos, record): the records of all files as bytes, blank ones left out.

    The order in a file is (block, pos). The table is written to the shared folder once.
    """
    lines = _lines(spark, path)
    states = scratch_path(spark, "csv-states")
    _split_states(lines, sep).write.parquet(states)
    # One small row per split of the input.
    at = F.broadcast(spark.read.parquet(states))
    target = scratch_path(spark, "csv-records")
    _records(lines.join(at, ["file", "block"]).select("line", "file", "block", "inside"), sep).write.parquet(target)
    rows = spark.read.schema(_RECORD).parquet(target)
    whole = rows.where(F.col("kind") == WHOLE).select("file", "block", "pos", "record")
    # At most two pieces per split; a piece without an open record before it belongs to the last one.
    pieces = rows.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "pos")
    owner = F.last(F.when(F.col("kind") == OPEN, F.struct("block", "pos")), ignorenulls=True).over(order)
    joined = pieces.withColumn("own", owner).groupBy("file", "own").agg(
        F.sort_array(F.collect_list(F.struct("block", "pos", "record"))).alias("p"))
    joined = joined.select("file", "own.block", "own.pos", F.concat_ws("\n", F.transform(
        "p", lambda x: F.decode(x["record"], "ISO-8859-1"))).alias("t"))
    joined = joined.select("file", "block", "pos", F.encode("t", "ISO-8859-1").alias("record"))
    return whole.unionByName(joined).where(~F.col("record").isin(bytearray(b""), bytearray(b"\r")))


def read_quoted(spark: SparkSession, path: str, schema: StructType, *, sep: str, header: bool, encoding: str) -> DataFrame:
    """The columns of ``schema`` plus ``_order`` = (file, block, pos)."""
    records = quoted_records(spark, path, sep)
    # The least position of the first block, with a bit for its line end: no record is sorted or shuffled for it.
    cr = F.substring(F.col("record"), -1, 1) == F.lit(bytearray(b"\r"))
    heads = records.where(F.col("block") == 0).groupBy(F.col("file").alias("hf")).agg(F.min(F.col("pos") * 2 + cr.cast("long")).alias("m"))
    heads = heads.select("hf", F.expr("m div 2").alias("hp"), (F.col("m") % 2 == 1).alias("cr"))
    # One row per file. A file whose first record ends in a carriage return has such line ends.
    records = records.join(F.broadcast(heads), F.col("file") == F.col("hf"), "left")
    if header:
        records = records.where(~((F.col("block") == 0) & (F.col("pos") == F.col("hp")) & F.col("hf").isNotNull()))
    whole = F.decode("record", "ISO-8859-1" if encoding == "latin-1" else "UTF-8")
    # In such files the reader takes a line break inside a field as one line feed.
    line = F.when(F.col("cr"), F.regexp_replace(F.regexp_replace("_t", "\r$", ""), "\r\n", "\n")).otherwise(F.col("_t"))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    parsed = records.withColumn("_t", whole).select(F.from_csv(line, ddl, options).alias("c"), F.struct("file", "block", "pos").alias("_order"))
    return parsed.select("c.*", "_order")
