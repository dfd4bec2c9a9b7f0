"""Streams against worked cases and against the batch operators.

``replay`` writes one JSON file per step and reads one file per micro-batch, so Spark's watermark,
which moves once per micro-batch, moves with every step.
"""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pyarrow as pa
import pytest
from helpers import rows
from pyspark.sql import Row, functions as F

from tidemark.functions.clock import DAY, HOUR, SECOND
from tidemark.functions.sizing import estimated_bytes
from tidemark.operators import distinct, joins, patterns, windows
from tidemark.plans import streams
from tidemark.sources import files
from tidemark.sources.files import events, events_stream as events_slices, json_lines_stream
from tidemark.streaming import forms, stateful as st
from tidemark.streaming.run import EndMarker, drain, drained, start

S = SECOND
END_S = 4_000_000_000


def replay(spark, tmp_path, schema, steps, name="in", end=None):
    """Stream with one micro-batch per step; times are seconds in column ``t``."""
    folder = tmp_path / name
    folder.mkdir()
    for i, step in enumerate([*steps, *([[end]] if end else [])]):
        path = folder / f"{i:04d}.json"
        path.write_text("".join(json.dumps(r) + "\n" for r in step))
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
    raw = json_lines_stream(spark, str(folder), schema, files_per_batch=1)
    if "t " not in schema:
        return raw
    us = (F.col("t") * S).cast("bigint")
    return raw.withColumn("us", us).withColumn("ts", F.timestamp_micros("us")).drop("t")


def keyed(pairs):
    return [[{"k": k, "t": t}] for k, t in pairs]


def test_tumbling_window_fires_when_the_watermark_passes(spark, tmp_path):
    steps = [[{"k": "a", "t": 1}, {"k": "a", "t": 2}], [{"k": "a", "t": 10}]]
    stream = replay(spark, tmp_path, "k string, t double", steps, end={"k": "end", "t": END_S})
    counts = windows.tumbling(stream.withWatermark("ts", "5 seconds"), ["k"], 5 * S, [F.count("*").alias("cnt")])
    assert rows(drained(counts)) == [("a", 0, 5 * S, 2), ("a", 10 * S, 15 * S, 1)]


def test_session_stream(spark, tmp_path):
    stream = replay(spark, tmp_path, "k string, t double", keyed([("a", 0), ("a", 1), ("a", 2), ("a", 12), ("end", END_S)]))
    got = drained(windows.sessions_stream(stream.withWatermark("ts", "0 seconds"), ["k"], 5 * S))
    assert rows(got) == [("a", 0, 7 * S, 3), ("a", 12 * S, 17 * S, 1)]


def test_inner_join_stream_keeps_full_history(spark, tmp_path):
    a = replay(spark, tmp_path, "k string, v int", [[{"k": "a", "v": 1}], [{"k": "b", "v": 3}], [{"k": "a", "v": 2}]], "a")
    b = replay(spark, tmp_path, "k string, w int", [[{"k": "a", "w": 5}], [{"k": "a", "w": 6}], [{"k": "b", "w": 7}]], "b")
    want = [("a", 1, 5), ("a", 1, 6), ("a", 2, 5), ("a", 2, 6), ("b", 3, 7)]
    assert rows(drained(joins.inner_join(a, b, ["k"])), "k", "v", "w") == want


def test_interval_join_stream(spark, tmp_path):
    m = lambda hhmm: (int(hhmm[:2]) * 60 + int(hhmm[3:])) * 60
    a = replay(spark, tmp_path, "k string, t double", keyed([("m", m("12:10")), ("m", m("13:00"))]), "a")
    b = replay(spark, tmp_path, "k string, t double", keyed([("m", m(x)) for x in ("11:20", "12:15", "13:25")]), "b")
    a = a.selectExpr("k", "ts AS o").withWatermark("o", "0 seconds")
    b = b.selectExpr("k", "ts AS c").withWatermark("c", "0 seconds")
    got = drained(forms.interval_join(a, b, ["k"], "o", "c", 3600 * S, 900 * S))
    want = [("12:10", "11:20"), ("12:10", "12:15"), ("13:00", "12:15")]
    assert rows(got.select(F.unix_seconds("o"), F.unix_seconds("c"))) == [(m(x), m(y)) for x, y in want]


def test_window_join_stream(spark, tmp_path):
    a = replay(spark, tmp_path, "k string, t double, v int", [[{"k": k, "t": t, "v": t}] for k, t in [("a", 1), ("b", 1), ("a", 2), ("b", 2)]], "a")
    b = replay(spark, tmp_path, "k string, t double, w int", [[{"k": k, "t": t, "w": t}] for k, t in [("a", 3), ("b", 3), ("a", 4), ("b", 4)]], "b")
    a, b = a.drop("us").withWatermark("ts", "5 seconds"), b.drop("us").withColumnRenamed("ts", "ts2").withWatermark("ts2", "5 seconds")
    got = drained(forms.window_join(a, b, ["k"], "ts", "ts2", 5 * S))
    assert rows(got, "k", "window_start", "v", "w") == [(k, 0, v, w) for k in "ab" for v in (1, 2) for w in (3, 4)]


def test_group_counts_update_mode(spark, tmp_path):
    stream = replay(spark, tmp_path, "user string", [[{"user": u}] for u in ("Mary", "Bob", "Mary", "Liz")])
    path = drain(forms.group_counts(stream, ["user"]), forms.group_counts_writer(), mode="update")
    changes = spark.read.parquet(path)
    assert rows(changes, "batch", "user", "cnt") == [(0, "Mary", 1), (1, "Bob", 1), (2, "Mary", 2), (3, "Liz", 1)]
    final = changes.groupBy("user").agg(F.max("cnt"))
    assert rows(final) == [("Bob", 1), ("Liz", 1), ("Mary", 2)]


HISTORY = "k string, type string, t double"


def history(spark, tmp_path, data, per_step=1, last="end"):
    steps = [[{"k": k, "type": ty, "t": t} for k, ty, t in data[i : i + per_step]] for i in range(0, len(data), per_step)]
    stream = replay(spark, tmp_path, HISTORY, steps, end={"k": "end", "type": last, "t": END_S})
    return stream.withWatermark("ts", "0 seconds")


FAILS = [("u1", "fail", 1), ("u2", "success", 2), ("u1", "fail", 3), ("u1", "fail", 4), ("u1", "fail", 5)]
ORDERS = [("o1", "create", 1), ("o2", "create", 2), ("o1", "pay", 4), ("o2", "pay", 9)]


def test_hit_run_and_sequence(spark, tmp_path):
    fail = lambda r: r.type == "fail"
    stream = history(spark, tmp_path, FAILS)
    assert rows(drained(st.in_order(stream, ["k"], st.HitRun(fail)))) == [("u1", 4 * S), ("u1", 5 * S)]
    got = rows(drained(st.in_order(stream, ["k"], st.Sequence([fail] * 3))))
    assert got == [("u1", [1 * S, 3 * S, 4 * S], "match"), ("u1", [3 * S, 4 * S, 5 * S], "match")]


def test_sequence_within_and_order_timeout(spark, tmp_path):
    create, pay = (lambda r: r.type == "create"), (lambda r: r.type == "pay")
    stream = history(spark, tmp_path, ORDERS, per_step=2)
    got = rows(drained(st.in_order(stream, ["k"], st.Sequence([create, pay], 5 * S))))
    assert got == [("o1", [1 * S, 4 * S], "match"), ("o2", [2 * S], "timeout")]
    got = rows(drained(st.in_order(stream, ["k"], st.OrderTimeout(create, pay, 5 * S))))
    assert got == [("o1", 4 * S, "paid"), ("o2", 7 * S, "timeout"), ("o2", 9 * S, "paid")]


def test_reconcile_two_inputs(spark, tmp_path):
    data = [("o1", "app", 1), ("o2", "app", 2), ("o1", "bank", 4), ("o2", "bank", 9)]
    got = drained(st.in_order(history(spark, tmp_path, data), ["k"], st.Reconcile(lambda r: r.type == "app", 5 * S)))
    assert rows(got.filter("k <> 'end'")) == [
        ("o1", 1 * S, 4 * S, "left_first"), ("o2", 2 * S, None, "left_only"), ("o2", None, 9 * S, "right_only")
    ]


def test_element_timers(spark, tmp_path):
    stream = history(spark, tmp_path, [("a", "x", 1), ("a", "x", 1), ("a", "x", 2)], per_step=2)
    assert rows(drained(st.in_order(stream, ["k"], st.ElementTimers(9_999_000)))) == [("a", 10_999_000), ("a", 11_999_000)]


def test_running_stats_emit_per_row(spark, tmp_path):
    data = [("a", "3", 1), ("a", "1", 2), ("b", "9", 3), ("a", "5", 4)]
    numbers = history(spark, tmp_path, data, per_step=2, last="0")
    got = drained(st.in_order(numbers, ["k"], st.Stats("type")))
    assert rows(got.filter("k <> 'end'")) == [
        ("a", S, 1, 3, 3, 3), ("a", 2 * S, 2, 4, 1, 3), ("a", 4 * S, 3, 9, 1, 5), ("b", 3 * S, 1, 9, 9, 9)
    ]


def test_late_rows_are_tagged_not_lost(spark, tmp_path):
    stream = replay(spark, tmp_path, "k string, t double", keyed([("a", 10), ("a", 4), ("a", 5), ("a", 20), ("a", 14)]))
    got = drained(st.tag_late(stream.withWatermark("ts", "5 seconds"), ["k"]))
    want = {4: True, 5: False, 10: False, 14: True, 20: False}
    assert {us // S: late for us, late in rows(got, "us", "is_late")} == want


def test_allowed_lateness_refires_then_side_output(spark, tmp_path):
    data = [("a", 1), ("a", 2), ("a", 10), ("a", 3), ("a", 4), ("a", 15), ("a", 4), ("end", END_S)]
    stream = replay(spark, tmp_path, "k string, t double", keyed(data)).withWatermark("ts", "5 seconds")
    got = drained(st.late_windows(stream, ["k"], 5 * S, lateness=5 * S))
    want = [
        (5 * S, 1, "side_output"), (5 * S, 2, "first"), (5 * S, 3, "refire"), (5 * S, 4, "refire"),
        (15 * S, 1, "first"), (20 * S, 1, "first"),
    ]
    assert sorted(rows(got.filter("k = 'a'"), "window_end", "cnt", "kind")) == want


def test_late_router_is_exact_per_record(spark, tmp_path):
    steps = [[{"k": "a", "seq": 0, "t": 10}, {"k": "a", "seq": 1, "t": 4}], [{"k": "b", "seq": 2, "t": 5}, {"k": "b", "seq": 3, "t": 4}]]
    stream = replay(spark, tmp_path, "k string, seq bigint, t double", steps)
    out = str(tmp_path / "routed")
    start(stream, str(tmp_path / "ck"), write=forms.late_router(out, ["seq"], 5 * S)).awaitTermination()
    got = spark.read.parquet(f"{out}/out")
    assert sorted(rows(got, "seq", "output")) == [(0, "main"), (1, "late"), (2, "main"), (3, "late")]


def test_union_takes_the_smaller_watermark(spark, tmp_path):
    a = replay(spark, tmp_path, "k string, t double", keyed([("a", 1), ("a", 100), ("a", 100)]), "a")
    b = replay(spark, tmp_path, "k string, t double", keyed([("b", 2), ("b", 3), ("b", 4)]), "b")
    both = a.withWatermark("ts", "0 seconds").unionByName(b.withWatermark("ts", "0 seconds"))
    counts = windows.tumbling(both, ["k"], 5 * S, [F.count("*").alias("cnt")])
    assert drained(counts).count() == 0  # the second input is still at 4 seconds


def test_full_outer_stream(spark, tmp_path):
    a = replay(spark, tmp_path, "id string, t double", [[{"id": "o1", "t": 1}], [{"id": "o2", "t": 2}], [{"id": "end", "t": END_S}]], "a")
    b = replay(spark, tmp_path, "id string, t double", [[{"id": "o1", "t": 4}], [{"id": "o2", "t": 9}], [{"id": "end2", "t": END_S}]], "b")
    left = a.selectExpr("id", "ts AS l").withWatermark("l", "0 seconds")
    right = b.selectExpr("id", "ts AS r").withWatermark("r", "0 seconds")
    got = drained(forms.reconcile(left, right, ["id"], "l", "r", 5 * S))
    assert rows(got, "id", "left_us", "right_us", "outcome") == [
        ("o1", 1 * S, 4 * S, "left_first"), ("o2", 2 * S, None, "left_only"), ("o2", None, 9 * S, "right_only")
    ]


def test_changelog_stream(spark, tmp_path):
    data = [(u, str(i), i + 1) for i, u in enumerate(["Mary", "Bob", "Mary", "Liz"])]
    got = drained(st.in_order(history(spark, tmp_path, data).withColumn("seq", F.expr("try_cast(type AS bigint)")), ["k"], st.CountChanges("seq")))
    assert rows(got.filter("k <> 'end'"), "seq", "row_kind", "k", "cnt") == [
        (0, "+I", "Mary", 1), (1, "+I", "Bob", 1), (2, "+U", "Mary", 2), (2, "-U", "Mary", 1), (3, "+I", "Liz", 1)
    ]


def test_control_filter_carries_the_last_control(spark, tmp_path):
    def data(u, t):
        return {"user": u, "want": None, "t": t}

    def control(u, t):
        return {"user": None, "want": u, "t": t}

    steps = [[data("Mary", 1), control("Mary", 2), data("Mary", 3)], [data("Mary", 4), data("Bob", 5), control("Bob", 6)], [data("Bob", 7), data("Mary", 8)]]
    stream = replay(spark, tmp_path, "user string, want string, t double", steps).drop("ts")
    write = forms.control_filter(str(tmp_path / "c"), F.col("want").isNotNull(), "us", "want", F.col("user") == F.col("want"))
    start(stream, str(tmp_path / "ck"), write=write).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "c/out")), "us") == [(3 * S,), (4 * S,), (7 * S,)]


def test_processing_time_timers(spark, tmp_path):
    stream = replay(spark, tmp_path, "k string", [[{"k": "a"}, {"k": "a"}]])
    query = start(st.processing_timers(stream, "k", 500), str(tmp_path / "ck"), str(tmp_path / "out"), every="300 milliseconds")
    try:
        for _ in range(60):
            query.awaitTermination(1)
            done = os.path.isdir(tmp_path / "out" / "_spark_metadata") and rows(spark.read.schema("k string, what string, n bigint, at_ms bigint").parquet(str(tmp_path / "out")))
            if done and len(done) == 2:
                break
    finally:
        query.stop()
    assert [(k, what, n) for k, what, n, _ in done] == [("a", "fired", 1), ("a", "seen", 2)]
    assert done[0][3] - done[1][3] == 500


def test_restart_continues_where_it_stopped(spark, tmp_path):
    def counts():
        raw = json_lines_stream(spark, str(tmp_path / "in"), "k string, t double", files_per_batch=1)
        timed = raw.withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", "0 seconds")
        return windows.tumbling(timed, ["k"], 5 * S, [F.count("*").alias("cnt")])

    def feed(i, pairs):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.json").write_text("".join(json.dumps({"k": k, "t": t}) + "\n" for k, t in pairs))

    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    feed(0, [("a", 1), ("a", 2), ("b", 6)])
    start(counts(), ck, out).awaitTermination()
    feed(1, [("a", 7), ("b", 8), ("end", END_S)])
    start(counts(), ck, out).awaitTermination()
    got = spark.read.schema(counts().schema).parquet(out)
    assert rows(got) == [("a", 0, 5 * S, 2), ("a", 5 * S, 10 * S, 1), ("b", 5 * S, 10 * S, 2)]


@pytest.fixture(scope="module")
def event_steps(spark, folder, tmp_path_factory):
    """Events of the smallest tables as 4 files in time order, plus the end marker."""
    base = tmp_path_factory.mktemp("events")
    table = events(spark, folder).withColumn("kind", F.col("event_type")).drop("props").orderBy("us").toPandas()
    out = base / "in"
    out.mkdir()
    for i in range(4):
        part = table.iloc[i * len(table) // 4 : (i + 1) * len(table) // 4]
        part.drop(columns="ts").to_parquet(out / f"{i}.parquet", index=False)
        os.utime(out / f"{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    schema = "event_id bigint, user_id bigint, event_type string, value double, us bigint, kind string"

    def stream():
        raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(out))
        return EndMarker(raw.withColumn("ts", F.timestamp_micros("us")), user_id=-1, event_type="end", kind="end")

    def run(operator):
        marker = stream()
        return drained(operator(marker.stream.withWatermark("ts", "0 seconds")), end=marker)

    return run


def test_stateful_equals_batch_on_events(spark, folder, event_steps):
    batch = events(spark, folder).select("user_id", "us", "event_type", "value", "event_id", "ts")
    error = patterns.repeats(batch, ["user_id"], ["us"], F.col("event_type") == "error", 3)
    got = event_steps(lambda s: st.in_order(s, ["user_id"], st.HitRun(lambda r: r.event_type == "error"), slot=HOUR))
    assert rows(got) == rows(error, "user_id", "us")

    rising = patterns.rising_alerts(batch, ["user_id"], ["us"], "value", 12 * HOUR)
    got = event_steps(lambda s: st.in_order(s, ["user_id"], st.RisingAlert("value", 12 * HOUR), slot=HOUR))
    assert rows(got) == rows(rising)

    early = windows.early_fires(batch, ["user_id"], DAY, 6 * HOUR)
    got = event_steps(lambda s: st.in_order(s, ["user_id"], st.EarlyFire(DAY, 6 * HOUR), slot=HOUR))
    assert rows(got.filter("user_id >= 0")) == rows(early, "user_id", "window_start", "fired_at", "cnt")

    opened = batch.filter("event_type = 'signup'").select("user_id", "us")
    want = joins.gate(batch.filter("event_type = 'view'").select("user_id", "us", "event_id"), opened, ["user_id"], "us", 24 * HOUR)
    kinds = F.col("event_type").isin("signup", "view", "end")
    got = event_steps(lambda s: st.in_order(s.filter(kinds), ["user_id"], st.Gate(lambda r: r.event_type == "signup", 24 * HOUR), slot=HOUR))
    assert rows(got.filter("user_id >= 0"), "user_id", "event_id") == rows(want, "user_id", "event_id")


def test_builtin_forms_equal_batch_on_events(spark, folder, event_steps):
    batch = events(spark, folder)
    got = event_steps(lambda s: distinct.uv_exact(s, DAY, "user_id"))
    assert rows(got) == rows(distinct.uv_exact(batch, DAY, "user_id"))
    got = event_steps(lambda s: distinct.uv_sketch(s, DAY, "user_id"))
    assert rows(got) == rows(distinct.uv_sketch(batch, DAY, "user_id"))
    got = event_steps(lambda s: windows.sessions_stream(s, ["user_id"], 12 * HOUR))
    assert rows(got) == rows(windows.sessions(batch, ["user_id"], 12 * HOUR))
    got = event_steps(lambda s: st.in_order(s, ["event_type"], st.EarlyFire(DAY), slot=HOUR)).select("event_type", "window_start", "cnt")
    want = windows.tumbling_by_hand(batch, ["event_type"], DAY)
    assert rows(got) == rows(want, "event_type", "window_start", "cnt")


def test_a_slot_written_in_three_micro_batches(spark, tmp_path):
    """One key, one slot, rows from three micro-batches: as good as one."""
    data = [("u", "fail", 1), ("u", "fail", 2), ("u", "fail", 3), ("u", "success", 4), ("u", "fail", 5)]
    fail = lambda r: r.type == "fail"
    for step in (1, 2, 5):
        part = tmp_path / str(step)
        part.mkdir()
        stream = history(spark, part, data, per_step=step)
        assert rows(drained(st.in_order(stream, ["k"], st.HitRun(fail), slot=60 * S))) == [("u", 3 * S)]


def test_more_rows_of_a_key_than_a_page_holds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st.InOrder, "PAGE_ROWS", 7)
    data = [("u", "fail", t) for t in range(1, 41)]
    stream = history(spark, tmp_path, data, per_step=20)
    got = drained(st.in_order(stream, ["k"], st.HitRun(lambda r: r.type == "fail"), slot=3600 * S))
    assert rows(got) == sorted((("u", t * S) for t in range(3, 41)), key=repr)


def test_restart_in_the_middle_of_a_slot(spark, tmp_path):
    data = [("u", "fail", t) for t in (1, 2, 3, 4)]
    folder, checkpoint, out = tmp_path / "in", str(tmp_path / "cp"), str(tmp_path / "out")
    folder.mkdir()

    def put(i, k, t):
        path = folder / f"{i:04d}.json"
        path.write_text(json.dumps({"k": k, "type": "fail", "t": t}) + "\n")
        os.utime(path, (1_000_000 + i, 1_000_000 + i))

    def run():
        raw = json_lines_stream(spark, str(folder), HISTORY, files_per_batch=1)
        timed = raw.withColumn("us", (F.col("t") * S).cast("bigint")).withColumn("ts", F.timestamp_micros("us")).drop("t")
        matched = st.in_order(timed.withWatermark("ts", "0 seconds"), ["k"], st.HitRun(lambda r: True), slot=60 * S)
        start(matched, checkpoint, out).awaitTermination()

    for i, (k, _, t) in enumerate(data[:2]):
        put(i, k, t)
    run()
    for i, (k, _, t) in enumerate([*data[2:], ("end", "fail", END_S)], 2):
        put(i, k, t)
    run()
    assert rows(spark.read.parquet(out).filter("k = 'u'")) == [("u", 3 * S), ("u", 4 * S)]


def test_recorded_events_come_in_many_micro_batches(spark, folder, tmp_path):
    stream = events_slices(spark, folder).withWatermark("ts", "0 seconds")
    query = start(windows.tumbling(stream, ["event_type"], DAY, [F.count("*").alias("cnt")]), str(tmp_path / "cp"), str(tmp_path / "out"))
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert len(progress) >= 8
    state = [p.stateOperators[0].numRowsTotal for p in progress]
    assert max(state) < 5 * 30  # windows that are over leave the state


class CountingStore:
    """State and timers of one group, as a dict that counts the calls."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def state(self, *_):
        return CountingState(self)

    getValueState = getMapState = state

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)

    def deleteTimer(self, t):
        self.calls += 1
        self.timers.remove(t)


class CountingState:
    def __init__(self, store):
        self.store, self.kept = store, {}

    def get(self):
        return self.getValue(())

    def getValue(self, k):
        self.store.calls += 1
        return self.kept.get(k)

    def update(self, v):
        self.updateValue((), v)

    def updateValue(self, k, v):
        self.store.calls += 1
        self.kept[k] = v

    def clear(self):
        self.removeKey(())

    def removeKey(self, k):
        self.store.calls += 1
        self.kept.pop(k, None)


@pytest.mark.parametrize("rows_of_a_page", [20_000, 700])
def test_state_calls_do_not_grow_with_slots_and_keys(spark, tmp_path, monkeypatch, rows_of_a_page):
    """3,000 rows of 60 keys, each in a slot of its own, in three micro-batches that are not in order of time."""
    monkeypatch.setattr(st.InOrder, "PAGE_ROWS", rows_of_a_page)
    kept = []
    monkeypatch.setattr(st.InOrder, "__init__", lambda self, *a, init=st.InOrder.__init__: (init(self, *a), kept.append(self))[0])
    st.in_order(history(spark, tmp_path, [("a", "fail", 1)]), ["k"], st.ElementTimers(90 * S))
    processor, store = kept[0], CountingStore()
    processor.init(store)
    make = Row("k", "type", "us", "ts")
    data = [make(f"k{i % 60}", "fail", i * S, None) for i in range(3000)]
    found = []
    for batch in range(3):
        part = data[batch * 1000 : batch * 1000 + 1000]
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda b=batch: max(0, b * 1_000_000 - 500))
        list(processor.handleInputRows((0,), iter(part[::-1]), values))
        found += expired(processor, store, values)
    found += expired(processor, store, SimpleNamespace(getCurrentWatermarkInMs=lambda: 9_000_000))
    assert sorted(tuple(r) for r in found) == sorted((r.k, r.us + 90 * S) for r in data)
    assert store.calls < 150 and not store.timers and not any(s.kept for s in (processor.waiting, processor.blocks, processor.held))


def expired(processor, store, values):
    found = []
    for t in sorted(x for x in store.timers if x <= values.getCurrentWatermarkInMs()):
        found += processor.handleExpiredTimer((0,), values, None)
        store.timers.remove(t)
    return found


def test_rows_reach_their_group_in_packs(spark, monkeypatch):
    """3,000 rows are a value a group, in their order, with nulls and nested columns; a page holds no more than it should."""
    data = [(f"k{i % 40}", None if i % 7 == 0 else i, (i, [str(i), None]), 3000 - i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v bigint, s struct<a: bigint, b: array<string>>, us bigint").coalesce(1)
    processor = st.InOrder(st.HitRun(lambda r: True), ["k"], df.columns, True, "k string, us bigint", "us", S, None)
    packs = st._packs(df, ["k"], df.columns).collect()
    assert len(packs) == len({r["__group"] for r in packs}) <= 40
    got = [r for p in packs for r in processor._arrived(p, 0)]
    assert sorted(got, key=lambda r: -r[3]) == data
    assert all(own == sorted(own, reverse=True) for p in packs for own in [[r[3] for r in processor._arrived(p, 0)]])
    monkeypatch.setattr(st.InOrder, "PAGE_ROWS", 30)
    assert max(len(processor._arrived(p, 0)) for p in st._packs(df, ["k"], df.columns).collect()) == 30


def test_late_rows_of_a_pack_are_dropped(spark, tmp_path):
    data = [("u", "x", t) for t in (1, 100, 200, 150, 50, 300)]
    got = drained(st.in_order(history(spark, tmp_path, data), ["k"], st.HitRun(lambda r: r.type == "x", 1)))
    assert rows(got) == sorted((("u", t * S) for t in (1, 100, 150, 200, 300)), key=repr)


def test_state_partitions_follow_the_size_of_the_table(spark, folder, monkeypatch):
    """A large table has as many as its bytes ask for, not all partitions of the session's shuffles."""
    monkeypatch.setattr(streams, "PARTITION_BYTES", 1 << 10)
    size = estimated_bytes(events(spark, folder))
    conf = {"spark.tidemark.smallInputBytes": "0", "spark.sql.shuffle.partitions": "200"}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        assert 4 < streams._partitions(spark, folder) == -(-size // 1024) < 200
        monkeypatch.setattr(streams, "PARTITION_BYTES", 1)
        assert streams._partitions(spark, folder) == 200
        monkeypatch.setattr(streams, "PARTITION_BYTES", 32 << 20)
        assert streams._partitions(spark, folder) == 4
    finally:
        spark.conf.unset("spark.tidemark.smallInputBytes")
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_results_leave_packed_and_a_group_is_visited_once(spark):
    """3,000 results are a value a visit, and a visit for rows works off what is over: no timer is left that is due."""
    inner = st.InOrder(st.ElementTimers(90 * S), ["k"], ["k", "us"], False, "k string, timer bigint", "us", S, None)
    processor, store = st.Packed(inner, pa.schema([("k", pa.string()), ("timer", pa.int64())])), CountingStore()
    processor.init(store)
    data = [Row("k", "us")(f"k{i % 60}", i * S) for i in range(1, 9001)]
    found, values = [], None
    for batch in range(4):
        now = batch * 3_000_000
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda now=now: now)
        visit = list(processor.handleInputRows((0,), iter(data[batch * 3000 : batch * 3000 + 3000]), values))
        assert len(visit) <= 1 and not any(t <= now for t in store.timers)
        found += visit
    values = SimpleNamespace(getCurrentWatermarkInMs=lambda: 19_000_000)
    found += [r for t in sorted(store.timers) for r in processor.handleExpiredTimer((0,), values, None)]
    got = [r for p in found for r in pa.ipc.open_stream(p[0]).read_all().to_pylist()]
    assert sorted((r["k"], r["timer"]) for r in got) == sorted((r.k, r.us + 90 * S) for r in data)
    assert store.calls < 80 and not any(s.kept for s in (inner.waiting, inner.blocks, inner.held))


def test_a_large_table_is_recorded_in_files_for_every_core(spark, folder, monkeypatch):
    """Slice after slice in order of time, none of its rows lost, each in as many files as there are cores."""
    monkeypatch.setattr(files, "SLICE_TASK_BYTES", 64)
    monkeypatch.setattr(files, "_recorded", {})
    path, n = files._record(spark, folder, 4, files.EVENT_TIME)
    assert n == spark.sparkContext.defaultParallelism > 1
    written = spark.read.parquet(path)
    assert written.schema == files.table(spark, folder, "events").schema
    assert sorted(written.collect(), key=repr) == sorted(files.table(spark, folder, "events").collect(), key=repr)
    seen = written.groupBy("_metadata.file_path", "_metadata.file_modification_time")
    spans = seen.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).orderBy("file_modification_time").collect()
    assert len(spans) == 4 * n
    edges = [(min(r.low for r in spans[a : a + n]), max(r.high for r in spans[a : a + n])) for a in range(0, 4 * n, n)]
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


def _spans(spark, path):
    """First and last time of every file of a recording, in the order a stream takes them."""
    seen = spark.read.parquet(path).groupBy("_metadata.file_path", "_metadata.file_modification_time")
    spans = seen.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).orderBy("file_modification_time").collect()
    return [(r.low, r.high) for r in spans]


def test_recording_takes_no_job_per_slice(spark, folder, monkeypatch):
    """One write for all slices: as many jobs for sixteen as for two."""
    monkeypatch.setattr(files, "SLICE_TASK_BYTES", 64)
    jobs = []
    for slices in (2, 16):
        monkeypatch.setattr(files, "_recorded", {})
        group = f"recording-{slices}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            files._record(spark, folder, slices, files.EVENT_TIME)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    assert 0 < jobs[0] == jobs[1]


def test_a_store_that_keeps_its_own_times_gets_the_slices_in_turn(spark, folder, monkeypatch):
    monkeypatch.setattr(files, "SLICE_TASK_BYTES", 64)
    monkeypatch.setattr(files, "_recorded", {})
    monkeypatch.setattr(files.storage, "date_by_name", lambda *_: False)
    path, n = files._record(spark, folder, 4, files.EVENT_TIME)
    assert n == spark.sparkContext.defaultParallelism
    assert sorted(spark.read.parquet(path).collect(), key=repr) == sorted(files.table(spark, folder, "events").collect(), key=repr)
    spans = _spans(spark, path)
    edges = [(min(s[0] for s in spans[a : a + n]), max(s[1] for s in spans[a : a + n])) for a in range(0, 4 * n, n)]
    assert len(spans) == 4 * n and all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


def test_slices_with_fewer_rows_than_files_stay_apart(spark, tmp_path, monkeypatch):
    """Nine rows of four seconds, one of them without a time, in a table large enough for several files a slice."""
    monkeypatch.setattr(files, "SLICE_TASK_BYTES", 1)
    times = [1, 1, 1, 1, 1, 2, 3, 4, None]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "event_id bigint, t bigint")
    data.select("event_id", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    path, n = files._record(spark, str(tmp_path), 4, files.EVENT_TIME)
    spans = _spans(spark, path)
    assert n == 1 and len(spans) == 2 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == list(range(8))


def test_the_end_row_comes_last_in_the_same_run(spark, folder, tmp_path, monkeypatch):
    """One run from start to end closes every window: the last row is a micro-batch of its own."""
    monkeypatch.setattr(files, "SLICE_TASK_BYTES", 64)
    monkeypatch.setattr(files, "_recorded", {})
    stream = events_slices(spark, folder, end={"user_id": -1, "event_type": "end"})
    counts = windows.tumbling(stream.withWatermark("ts", "0 seconds"), ["event_type"], DAY, [F.count("*").alias("cnt")])
    query = start(counts, str(tmp_path / "cp"), str(tmp_path / "out"))
    query.awaitTermination()
    taken = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert len(taken) == files.SLICES + 1 and taken[-1] == 1
    whole = windows.tumbling(events(spark, folder), ["event_type"], DAY, [F.count("*").alias("cnt")])
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(whole)


def test_a_visit_with_a_block_of_rows_takes_few_calls():
    """The watermark that a group has seen is kept with what waits: 1,500 rows a visit take ten calls."""
    processor, store = st.InOrder(st.HitRun(lambda r: True, 3), ["k"], ["k", "us"], False, "k string, us bigint", "us", S, None), CountingStore()
    processor.init(store)
    found, calls = 0, []
    for batch in range(4):
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda now=batch * 1_500_000: now)
        before = store.calls
        data = [Row("k", "us")("a", (batch * 1500 + i) * S) for i in range(1, 1501)]
        found += sum(len(page) for page in processor.visit((0,), iter(data), values))
        calls.append(store.calls - before)
    assert found > 4000 and max(calls) <= 10
