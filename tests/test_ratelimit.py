from collections import deque
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from msgsift.streaming.limiter_state import LimiterProcessor, decide, late_counts, rate_limit_stateful, rocksdb_state
from msgsift.streaming.ratelimit import rate_limit_decisions, rate_limit_stream
from tests.conftest import SF


def _brute(events, R, W):
    out, by = {}, {}
    for eid, uid, t in sorted(events, key=lambda e: (e[1], e[2], e[0])):
        dq = by.setdefault(uid, deque())
        while dq and dq[0] <= t - W:
            dq.popleft()
        if len(dq) >= R:
            out[eid] = (False, max(1, int(W - (t - dq[0]) + 0.999)))
        else:
            dq.append(t)
            out[eid] = (True, 0)
    return out


def test_limiter_trace(spark):
    base = datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, 7, base), (2, 7, base + timedelta(seconds=1)),
                                (3, 7, base + timedelta(seconds=2)), (4, 7, base + timedelta(seconds=11))],
                               "event_id long, user_id long, ts timestamp")
    got = {r.event_id: (r.allowed, r.retry_after) for r in
           rate_limit_decisions(ev, requests=2, window_seconds=10).collect()}
    assert got == {1: (True, 0), 2: (True, 0), 3: (False, 8), 4: (True, 0)}


def test_chunked_fold_equals_sequential_fold(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    rows = [(r.event_id, r.user_id, (r.ts - datetime(1970, 1, 1)).total_seconds()) for r in
            ev.select("event_id", "user_id", "ts").collect()]
    W = 6 * 3600.0
    exp = _brute(rows, 2, W)
    # tiny chunks force many carry rounds
    got = rate_limit_decisions(ev, requests=2, window_seconds=W, chunk_events=3).collect()
    assert {r.event_id: (r.allowed, r.retry_after) for r in got} == exp
    # one hot user: every event re-keyed to the same client
    hot = ev.withColumn("user_id", F.lit(1))
    exp_hot = _brute([(e, 1, t) for e, _, t in rows], 3, 3600.0)
    got_hot = rate_limit_decisions(hot, requests=3, window_seconds=3600.0, chunk_events=7).collect()
    assert {r.event_id: (r.allowed, r.retry_after) for r in got_hot} == exp_hot


def _stream(spark, folder, batches, **kw):
    """Decisions of a stream that gets one file per micro-batch."""
    schema = "event_id long, user_id string, ts timestamp"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    q = (rate_limit_stream(src, **kw).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return {r.event_id: (r.allowed, r.retry_after) for r in spark.read.parquet(f"{folder}/out").collect()}


def test_stream_state_carries_over_micro_batches(spark, tmpdir_path):
    base = datetime(2024, 1, 1)
    rows = [(i, f"client-{i % 3}", base + timedelta(seconds=i * 7 % 11 + i * 5)) for i in range(90)]
    rows.sort(key=lambda r: r[2])
    exp = rate_limit_decisions(spark.createDataFrame(rows, "event_id long, user_id string, ts timestamp"), requests=2, window_seconds=40).collect()
    got = _stream(spark, tmpdir_path, [rows[:30], rows[30:31], rows[31:70], rows[70:]], requests=2, window_seconds=40)
    assert got == {r.event_id: (r.allowed, r.retry_after) for r in exp}
    assert any(not a for a, _ in got.values())


def test_late_events_count_at_the_clients_clock(spark, tmpdir_path):
    """The clock of a client never runs backwards: a late event is decided as if it came now."""
    base = datetime(2024, 1, 1)
    at = lambda s: base + timedelta(seconds=s)
    got = _stream(spark, tmpdir_path, [[(1, "a", at(100)), (2, "a", at(101))], [(3, "a", at(50)), (4, "a", at(112)), (5, "b", at(60))]],
                  requests=2, window_seconds=10, lateness="10 minutes")
    assert got == {1: (True, 0), 2: (True, 0), 3: (False, 9), 4: (True, 0), 5: (True, 0)}


def test_stream_parts_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    """A part of the events arrives in several files, not through one task; the decisions are the batch ones."""
    from msgsift.plans import queries
    from tests.conftest import SF
    monkeypatch.setattr(queries, "scratch_path", lambda *a: str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.event_id: (r.user_id, r.allowed, r.retry_after) for r in queries.QUERIES["rate_limit_stream"](spark, SF).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = queries.QUERIES["rate_limit_decisions"](spark, SF).collect()
    assert got == {r.event_id: (r.user_id, r.allowed, r.retry_after) for r in want}
    assert len(list((tmp_path / "in").glob("part-*.parquet"))) > 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=40), st.integers(1, 4), st.integers(1, 15), st.integers(0, 40))
def test_decide_equals_a_fold_however_it_is_cut(seconds, requests, window, cut):
    t = np.sort(np.asarray(seconds, np.int64)) * 1_000_000
    want = _brute([(i, 0, int(x) // 1_000_000) for i, x in enumerate(t)], requests, window)
    a, ra, held = decide(t[:cut], [], requests, window * 1_000_000)
    b, rb, held = decide(t[cut:], held, requests, window * 1_000_000)
    got = list(zip([*a, *b], [*ra, *rb], strict=True))
    assert got == [want[i] for i in range(len(t))] and len(held) <= requests


SCHEMA = "event_id long, user_id string, ts timestamp"


def _stateful(spark, folder, batches, schema=SCHEMA, **kw):
    with rocksdb_state(spark):
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            src = spark.readStream.schema(schema).parquet(f"{folder}/in")
            q = (rate_limit_stateful(src, **kw).writeStream.format("parquet").partitionBy("late").option("path", f"{folder}/out")
                 .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start())
            q.awaitTermination()
    kind = spark.createDataFrame([], schema).schema["user_id"].dataType.simpleString()
    return spark.read.schema(f"event_id long, user_id {kind}, t_us long, allowed boolean, retry_after long, late boolean").parquet(f"{folder}/out")


def _state(spark, folder, name):
    rows = spark.read.format("statestore").option("stateVarName", name).load(f"{folder}/ck").collect()
    return sorted({str(r.key[0]) for r in rows})


def test_stateful_limiter_lists_late_events_and_ends_with_empty_state(spark, tmpdir_path):
    base = datetime(2024, 1, 1)
    at = lambda s: base + timedelta(seconds=s)
    batches = [[(1, "a", at(100)), (2, "a", at(101)), (11, "c", None)],
               [(3, "a", at(50)), (4, "a", at(112)), (5, "b", at(60)), (9, "a", at(100)), (9, "a", at(100))],
               [(7, "z", at(5000)), (8, None, at(5001))],
               [(10, "a", at(112)), (12, "z", at(5002))]]
    out = _stateful(spark, tmpdir_path, batches, requests=2, window_seconds=10, lateness="30 seconds")
    got = [(r.event_id, r.user_id, r.allowed, r.retry_after, r.late) for r in out.orderBy("event_id").collect()]
    assert got == [(1, "a", True, 0, False), (2, "a", True, 0, False), (3, "a", None, None, True), (4, "a", True, 0, False),
                   (5, "b", None, None, True), (7, "z", True, 0, False), (8, None, True, 0, False), (9, "a", False, 9, False),
                   (9, "a", False, 9, False), (10, "a", None, None, True), (12, "z", True, 0, False)]
    assert {r.user_id: r.late_events for r in late_counts(out).collect()} == {"a": 2, "b": 1}
    # The window of clients a and b has passed: only the last two clients still hold state.
    for name in ("allowed_us", "clock_us"):
        assert _state(spark, tmpdir_path, name) == ["None", "z"]


def test_stateful_limiter_with_a_hot_client_equals_the_batch_operator(spark, tmpdir_path):
    """One client holds a third of all events; its events come in several micro-batches of bounded size."""
    rows = [(i, 1 if i % 3 == 0 else i % 17, datetime(2024, 1, 1) + timedelta(seconds=i // 2)) for i in range(3000)]
    schema = "event_id long, user_id int, ts timestamp"
    out = _stateful(spark, tmpdir_path, [rows[i:i + 600] for i in range(0, 3000, 600)], schema, requests=3, window_seconds=45)
    want = rate_limit_decisions(spark.createDataFrame(rows, schema), requests=3, window_seconds=45).collect()
    assert not out.where("late").count()
    got = {r.event_id: (r.user_id, r.allowed, r.retry_after) for r in out.collect()}
    assert len(got) == out.count() == 3000
    assert got == {r.event_id: (r.user_id, r.allowed, r.retry_after) for r in want}


def test_stateful_limiter_needs_a_positive_quota(spark):
    with pytest.raises(ValueError, match="requests is 0"):
        rate_limit_stateful(spark.readStream.format("rate").load(), requests=0, client_col="value", time_col="timestamp", id_col="value")


class _Calls:
    """Stands for the handle, both states and the timer values of a client without state; counts the calls."""

    def __init__(self, watermark_ms=0):
        self.watermark_ms, self.calls = watermark_ms, []

    def getListState(self, *a):
        return self

    getValueState = getListState

    def getCurrentWatermarkInMs(self):
        return self.watermark_ms

    def __getattr__(self, name):
        return lambda *a: self.calls.append(name)


def test_a_client_whose_window_the_micro_batch_closes_takes_one_call_and_one_row():
    s = 1_000_000
    for delay_ms, stored in ((30_000, False), (39_999, False), (40_001, True), (200_000, True), (None, True)):
        calls, p = _Calls(), LimiterProcessor(2, 10 * s, delay_ms)
        p.init(calls)
        list(p.handleInputRows(("b",), [(1, "b", 150 * s)], calls))
        calls.calls.clear()
        out = list(p.handleInputRows(("a",), [(5, "a", 100 * s), (4, "a", 99 * s), (6, "a", 100 * s)], calls))
        assert [(r.client, r.late, list(r.event_id), list(r.retry_after)) for r in out] == [("a", False, [4, 5, 6], [0, 0, 9])]
        assert calls.calls == ["exists"] + stored * ["put", "update", "registerTimer"], delay_ms


def test_the_only_watermark_of_a_query_changes_no_decision(spark, tmp_path):
    """Quiet clients are not stored, those whose window stays open are; late events and the rest are as before."""
    base = datetime(2024, 1, 1)
    rows = [(i, f"client-{i * i % 23}", base + timedelta(seconds=i * 3 + i * 7 % 20)) for i in range(400)]
    batches = [rows[:150], rows[150:151], rows[151:300], [*rows[300:], (1000, "client-1", base), (1001, None, rows[-1][2])]]
    got = []
    for only in (False, True):
        out = _stateful(spark, f"{tmp_path}/{only}", batches, requests=2, window_seconds=120, lateness="60 seconds", only_watermark=only)
        got.append(sorted((tuple(r) for r in out.collect()), key=str))
    assert got[0] == got[1] and len(got[0]) == 402
    assert [r[0] for r in got[0] if r[5]] == [1000] and any(r[3] is False for r in got[0])
    for name in ("allowed_us", "clock_us"):
        assert _state(spark, f"{tmp_path}/True", name) == _state(spark, f"{tmp_path}/False", name) != []
