"""Streaming rate limiter on keyed state with timers, and a dead-letter table for late events.

The decisions are those of ``ratelimit.rate_limit_decisions``. Each client keeps, in the RocksDB state
store, a list of its allowed times inside the window (at most R) and its clock (the time of its
last decided event). One event-time timer per client, set to the clock plus the window, clears
both, so a quiet client costs no state. (The store's own TTL counts processing time only, which
would make a replay differ from the live run.)

Events behind the watermark are not decided and not lost: they leave the operator with
``late = true``. Spark filters late rows before a stateful operator when it sees the watermark
column among the input columns, so only the plain microseconds are passed on; the watermark itself
still advances below. Written with ``partitionBy("late")``, decisions and dead letters are two folders
of one exactly-once sink.

A micro-batch's events of one client are held in one task as two arrays of eight bytes per event and
folded in time order. What a task holds is bounded by the source's trigger size, whatever share of
the events one client has; the fold itself steps from one allowed event to the next and skips
denied stretches at once.

With many clients of few events each, the time goes into the steps per client and micro-batch: calls to
the state store (a round trip each) and frames built. So a client's decisions leave as one row of
arrays, which Spark unfolds, and its timer is told from its clock, not looked up. In a query without
another watermark, clients whose window the watermark of this very micro-batch closes are not stored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from msgsift.streaming.ratelimit import US, epoch_micros

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: Events per row that leaves the operator.
OUT_EVENTS = 10_000

#: Some events of one client, in time order; those with nothing to wait for are allowed.
DECISIONS = StructType([
    StructField("client", StringType()), StructField("late", BooleanType()), StructField("event_id", ArrayType(LongType())),
    StructField("t_us", ArrayType(LongType())), StructField("retry_after", ArrayType(LongType())),
])


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB with changelog checkpoints."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def decide(times: np.ndarray, held: list[int], requests: int, window_us: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Decisions for ascending ``times`` after the allowed times ``held``: (allowed, retry_after,
    allowed times still held at the last event). All events up to the moment the oldest held time
    leaves a full window are denied, and found by one binary search."""
    n = len(times)
    allowed, retry = np.zeros(n, bool), np.zeros(n, np.int64)
    dq = deque(held)
    i = 0
    while i < n:
        t = int(times[i])
        while dq and dq[0] <= t - window_us:
            dq.popleft()
        if len(dq) < requests:
            allowed[i] = True
            dq.append(t)
            i += 1
            continue
        j = int(np.searchsorted(times, dq[0] + window_us, "left"))
        wait = (window_us - (times[i:j] - dq[0])) / US
        retry[i:j] = np.maximum(1, np.floor(wait + 0.999)).astype(np.int64)
        i = j
    return allowed, retry, list(dq)


class LimiterProcessor(StatefulProcessor):
    """Allowed times and clock of one client; see the module text.

    ``delay_ms`` is how far the watermark stays behind the newest event, or None if another watermark of
    the query may hold it back.
    """

    def __init__(self, requests: int, window_us: int, delay_ms: int | None = None):
        self.requests, self.window_us, self.delay_ms = requests, window_us, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.allowed_us = handle.getListState("allowed_us", StructType([StructField("t_us", LongType())]))
        self.clock_us = handle.getValueState("clock_us", StructType([StructField("t_us", LongType())]))
        self.newest_us = None  # of the task's events so far

    def _timer(self, clock: int) -> int:
        return (clock + self.window_us) // 1000 + 1

    def _closed(self, clock: int) -> bool:
        """Whether no event after this micro-batch can fall into the window that ``clock`` opened: the next
        watermark is at least that of the newest event seen, and an event behind it is late."""
        if self.delay_ms is None:
            return False
        mark = self.newest_us // 1000 - self.delay_ms
        return mark > 0 and mark * 1000 >= clock + self.window_us

    def _rows(self, client, ids, t, retry, late) -> Iterator[Row]:
        for i in range(0, len(ids), OUT_EVENTS):
            s = slice(i, i + OUT_EVENTS)
            yield Row(client=client, late=late, event_id=ids[s], t_us=t[s], retry_after=retry[s])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pairs = np.fromiter((x for event_id, _client, t_us in rows for x in (t_us, event_id)), np.int64).reshape(-1, 2)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        t, ids = pairs[order, 0], pairs[order, 1]
        self.newest_us = int(t[-1]) if self.newest_us is None else max(self.newest_us, int(t[-1]))
        mark = timerValues.getCurrentWatermarkInMs()  # 0 before the first one
        n_late = int(np.searchsorted(t, mark * 1000, "left")) if mark > 0 else 0
        if n_late:
            yield from self._rows(key[0], ids[:n_late], t[:n_late], np.zeros(n_late, np.int64), True)
            t, ids = t[n_late:], ids[n_late:]
        if not len(t):
            return
        clock = self.clock_us.get()[0] if self.clock_us.exists() else None
        # Nothing that is held counts any more once the window after the clock is over.
        held = sorted(r[0] for r in self.allowed_us.get()) if clock is not None and t[0] < clock + self.window_us else []
        now = t if clock is None else np.maximum(t, clock)
        _allowed, retry, held = decide(now, held, self.requests, self.window_us)
        self._keep(clock, int(now[-1]), held)
        yield from self._rows(key[0], ids, t, retry, False)

    def _keep(self, old: int | None, clock: int, held: list[int]) -> None:
        """Stores a client's state after its events; ``old`` is the clock stored before."""
        closed = self._closed(clock)
        if old is not None and (closed or self._timer(old) != self._timer(clock)):
            self.handle.deleteTimer(self._timer(old))
        if not closed:
            self.allowed_us.put([(int(x),) for x in held]) if held else self.allowed_us.clear()
            self.clock_us.update((clock,))
            if old is None or self._timer(old) != self._timer(clock):
                self.handle.registerTimer(self._timer(clock))
        elif old is not None:
            self.allowed_us.clear()
            self.clock_us.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.allowed_us.clear()
        self.clock_us.clear()
        return iter([])

    def close(self) -> None:
        pass


def rate_limit_stateful(events_stream: DataFrame, *, requests: int = 30, window_seconds: float = 60.0,
                        client_col: str = "user_id", time_col: str = "ts", id_col: str = "event_id",
                        lateness: str = "1 hour", only_watermark: bool = False) -> DataFrame:
    """(event_id, client, event time in microseconds, allowed, retry_after, late) of every event.

    In-order input gives the batch operator's decisions however it is cut into micro-batches. An event
    that is not behind the watermark but older than its client's last decided one counts as happening
    at that one's time. An event behind the watermark of its micro-batch is late: ``allowed`` and
    ``retry_after`` are null, and it uses no quota. Events without a time or an id take no part; a null
    client is a client of its own. Start the query inside ``rocksdb_state``.

    ``only_watermark`` says that the query sets no other watermark before or after this operator, so that
    none can hold this one back; state is then written only for clients whose window stays open.
    """
    if requests < 1:
        raise ValueError(f"requests is {requests}; a window admits 1 or more")
    kind = events_stream.schema[client_col].dataType
    t_us = epoch_micros(events_stream, time_col)
    ev = events_stream.select(
        F.col(id_col).cast("long").alias("event_id"), F.col(client_col).cast("string").alias("client"),
        F.timestamp_micros(t_us).alias("event_time"), t_us.alias("t_us"),
    ).where("event_time IS NOT NULL AND event_id IS NOT NULL").withWatermark("event_time", lateness)
    delay_ms = ev.schema["event_time"].metadata.get("spark.watermarkDelayMs") if only_watermark else None
    out = ev.select("event_id", "client", "t_us").groupBy("client").transformWithState(
        LimiterProcessor(requests, int(round(window_seconds * US)), delay_ms), DECISIONS, "Append", "EventTime")
    out = out.select("client", "late", F.inline(F.arrays_zip("event_id", "t_us", "retry_after")))
    return out.select("event_id", F.col("client").cast(kind).alias(client_col), "t_us",
                      F.when(~F.col("late"), F.col("retry_after") == 0).alias("allowed"),
                      F.when(~F.col("late"), F.col("retry_after")).alias("retry_after"), "late")


def late_counts(results: DataFrame, client_col: str = "user_id") -> DataFrame:
    """(client, late_events, first_t_us, last_t_us) of the dead letters, one row per client that has any."""
    return results.where("late").groupBy(client_col).agg(
        F.count(F.lit(1)).alias("late_events"), F.min("t_us").alias("first_t_us"), F.max("t_us").alias("last_t_us"))
