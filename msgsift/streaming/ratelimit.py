"""Sliding-window rate-limit decisions, batch and streaming.

Semantics (per client): an event at time t is allowed iff fewer than ``R`` *allowed*
events lie in (t - W, t]; denied events consume no quota; a denied event carries
retry_after = max(1, floor(W - (t - oldest_allowed_in_window) + 0.999)) seconds.

This is a recurrence over decisions, not a window count, so it is a fold. To keep a
client that owns a third of all events from serialising the job, the batch
operator is exact *and* parallel inside one client:

* each client's events are numbered in time order and cut into chunks of ``chunk_events``
  events, whatever their density; all that a chunk needs from the past is the carry: the latest
  allowed timestamps before it, at most R;
* a chunk's fold maps a carry-in to a carry-out. Round 0 folds every chunk in parallel with an
  empty carry; a later round folds only the chunks whose carry-in changed, and writes only the
  small carry table. The loop ends when no carry changes (exact; limiter states synchronise
  within a window, so that takes a few rounds);
* the decisions are made once, in a last fold with the settled carries;
* the fold runs in ``mapInPandas`` over data sorted by (client, chunk, time) and streams through
  Arrow batches with O(R) state - no group is ever materialised;
* events and every round's carries are reliable checkpoints (executor-loss safe).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from msgsift.session import cut_lineage

US = 1_000_000

_FOLD_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("client", StringType()),
    StructField("chunk", LongType()),
    StructField("t_us", LongType()),
    StructField("allowed", BooleanType()),
    StructField("retry_after", LongType()),
])


def epoch_micros(df: DataFrame, col: str):
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ, independent of the
    session time zone for wall-clock (NTZ) input."""
    if df.schema[col].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))


def retry_seconds(window_us: int, t_us: int, oldest_us: int) -> int:
    return max(1, int(np.floor((window_us - (t_us - oldest_us)) / US + 0.999)))


def _make_fold(requests: int, window_us: int):
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = None
        dq: deque[int] = deque()
        for pdf in batches:
            n = len(pdf)
            allowed = np.zeros(n, dtype=bool)
            retry = np.zeros(n, dtype=np.int64)
            clients = pdf["client"].to_numpy()
            chunks = pdf["chunk"].to_numpy()
            ts = pdf["t_us"].to_numpy()
            carries = pdf["carry"].to_numpy()
            for i in range(n):
                k = (clients[i], chunks[i])
                if k != key:
                    key = k
                    c = carries[i]
                    dq = deque(sorted(int(x) for x in c)) if c is not None else deque()
                t = int(ts[i])
                cutoff = t - window_us
                while dq and dq[0] <= cutoff:
                    dq.popleft()
                if len(dq) >= requests:
                    retry[i] = retry_seconds(window_us, t, dq[0])
                else:
                    dq.append(t)
                    allowed[i] = True
            yield pd.DataFrame({
                "event_id": pdf["event_id"].to_numpy(), "client": clients, "chunk": chunks, "t_us": ts,
                "allowed": allowed, "retry_after": retry,
            })

    return fold


def _carry_fold(requests: int, window_us: int):
    """Carry-out of each chunk: its allowed timestamps at the end, one row per chunk.

    A chunk never spans two tasks, so a key change ends it.
    """
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, dq = None, deque()

        def row():
            return pd.DataFrame({"client": [key[0]], "chunk": [key[1]], "out": [list(dq)]})

        for pdf in batches:
            for client, chunk, t, c in zip(pdf["client"], pdf["chunk"], pdf["t_us"], pdf["carry"], strict=True):
                if (client, chunk) != key:
                    if key is not None:
                        yield row()
                    key, dq = (client, chunk), deque(sorted(int(x) for x in c)) if c is not None else deque()
                while dq and dq[0] <= t - window_us:
                    dq.popleft()
                if len(dq) < requests:
                    dq.append(int(t))
        if key is not None:
            yield row()

    return fold


def _in_order(ev: DataFrame) -> DataFrame:
    parts = int(ev.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ev.repartition(parts, "client", "chunk").sortWithinPartitions("client", "chunk", "t_us", "event_id")


def _numbered(ev: DataFrame, chunk_events: int) -> DataFrame:
    """Events with ``chunk`` = their rank among the client's events, divided by ``chunk_events``.

    Clients are spread over tasks by time: events are range-partitioned by (client, time), so a
    hot client fills several ranges, and each range adds its client's count in the ranges before.
    """
    spark = ev.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["client", "t_us", "event_id"]
    ranged = cut_lineage(ev.repartitionByRange(parts, *order).withColumn("pid", F.spark_partition_id()))
    counts = ranged.groupBy("client", "pid").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("client").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(F.col("client").alias("oc"), F.col("pid").alias("op"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("off"))
    inside = Window.partitionBy("pid", "client").orderBy("t_us", "event_id")
    ranked = ranged.withColumn("r", F.row_number().over(inside)).join(
        offs, F.col("client").eqNullSafe(F.col("oc")) & (F.col("pid") == F.col("op")))
    rank = F.col("off") + F.col("r") - 1
    return cut_lineage(ranked.select("event_id", "client", "t_us", F.floor(rank / F.lit(chunk_events)).cast("long").alias("chunk")))


def rate_limit_decisions(events: DataFrame, *, requests: int = 30, window_seconds: float = 60.0,
                         client_col: str = "user_id", time_col: str = "ts", id_col: str = "event_id",
                         chunk_events: int = 50_000) -> DataFrame:
    """(event_id, user_id, allowed, retry_after) for every event, exact. Clients may be of any type."""
    window_us = int(round(window_seconds * US))
    kind = events.schema[client_col].dataType
    ev = events.select(F.col(id_col).cast("long").alias("event_id"), F.col(client_col).cast("string").alias("client"),
                       epoch_micros(events, time_col).alias("t_us"))
    ev = _numbered(ev, chunk_events)
    empty = F.lit(None).cast(ArrayType(LongType()))
    schema = "client string, chunk long, out array<long>"
    settled = cut_lineage(_in_order(ev.withColumn("carry", empty)).mapInPandas(_carry_fold(requests, window_us), schema)
                          .withColumn("carry", empty))
    while True:
        moved = settled.select(F.col("client").alias("mc"), (F.col("chunk") + 1).alias("mk"), F.col("out").alias("carry_new"))
        now = settled.join(moved, F.col("client").eqNullSafe(F.col("mc")) & (F.col("chunk") == F.col("mk")), "left")
        full = F.when(F.size("carry_new") > 0, F.col("carry_new"))
        now = cut_lineage(now.select("client", "chunk", "out", "carry", full.alias("carry_new")))
        changed = now.filter(~F.col("carry_new").eqNullSafe(F.col("carry"))).select(
            F.col("client").alias("cc"), F.col("chunk").alias("ck"), F.col("carry_new").alias("carry"))
        if changed.isEmpty():
            break
        redo = ev.join(changed, F.col("client").eqNullSafe(F.col("cc")) & (F.col("chunk") == F.col("ck")))
        fresh = _in_order(redo.select("event_id", "client", "chunk", "t_us", "carry")).mapInPandas(_carry_fold(requests, window_us), schema)
        fresh = fresh.select(F.col("client").alias("fc"), F.col("chunk").alias("fk"), F.col("out").alias("out_new"))
        settled = cut_lineage(now.join(fresh, F.col("client").eqNullSafe(F.col("fc")) & (F.col("chunk") == F.col("fk")), "left").select(
            "client", "chunk", F.coalesce("out_new", "out").alias("out"), F.col("carry_new").alias("carry")))
    last = settled.select(F.col("client").alias("lc"), F.col("chunk").alias("lk"), "carry")
    final = ev.join(last, F.col("client").eqNullSafe(F.col("lc")) & (F.col("chunk") == F.col("lk"))).select(
        "event_id", "client", "chunk", "t_us", "carry")
    decisions = _in_order(final).mapInPandas(_make_fold(requests, window_us), _FOLD_SCHEMA)
    return decisions.select("event_id", F.col("client").cast(kind).alias(client_col), "allowed", "retry_after")


# -- streaming ------------------------------------------------------------------------------

def rate_limit_stream(events_stream: DataFrame, *, requests: int = 30, window_seconds: float = 60.0,
                      client_col: str = "user_id", time_col: str = "ts", id_col: str = "event_id",
                      lateness: str = "1 hour") -> DataFrame:
    """Streaming limiter in order of arrival: per-client state of at most R allowed timestamps.

    A micro-batch's events of a client are decided in time order. A client's clock never runs
    backwards: an event that is older than one already decided counts as happening at that time,
    as for a server that stamps requests when they come in. In-order input gives the batch
    operator's decisions however it is cut into micro-batches. Events behind the watermark by more
    than ``lateness`` are left to the stream's dead-letter handling (Spark drops them), and a
    client's state expires once the watermark has passed its last event by the window.

    A client's rows arrive sorted by Spark's shuffle in Arrow batches; only (time, id) pairs of one
    client and micro-batch are held, which the trigger's size limits.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    window_us = int(round(window_seconds * US))
    kind = events_stream.schema[client_col].dataType
    out_schema = StructType([
        StructField("event_id", LongType()), StructField("client", StringType()),
        StructField("allowed", BooleanType()), StructField("retry_after", LongType()),
    ])
    state_schema = StructType([StructField("allowed_us", ArrayType(LongType())), StructField("clock_us", LongType())])

    def step(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        old, clock = state.get if state.exists else ([], None)
        dq: deque[int] = deque(old)
        rows = sorted((int(t), int(i)) for pdf in pdfs for t, i in zip(pdf["t_us"], pdf["event_id"], strict=True))
        ids, allowed, retry = [], [], []
        for t, i in rows:
            clock = t if clock is None else max(clock, t)
            while dq and dq[0] <= clock - window_us:
                dq.popleft()
            ok = len(dq) < requests
            ids.append(i)
            allowed.append(ok)
            retry.append(0 if ok else retry_seconds(window_us, clock, dq[0]))
            if ok:
                dq.append(clock)
        state.update((list(dq), clock))
        state.setTimeoutTimestamp(max((clock + window_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"event_id": np.asarray(ids, np.int64), "client": [key[0]] * len(ids),
                            "allowed": np.asarray(allowed, bool), "retry_after": np.asarray(retry, np.int64)})

    ev = events_stream.select(
        F.col(id_col).cast("long").alias("event_id"),
        F.col(client_col).cast("string").alias("client"),
        F.col(time_col).cast("timestamp").alias("event_time"),
        epoch_micros(events_stream, time_col).alias("t_us"),
    ).withWatermark("event_time", lateness)
    out = ev.groupBy("client").applyInPandasWithState(step, out_schema, state_schema, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("event_id", F.col("client").cast(kind).alias(client_col), "allowed", "retry_after")
