"""Exact lateness on streams, the versioned table, triggers, patterns and window functions."""

from __future__ import annotations

import json
import random

import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.functions import storage
from tidemark.operators import distinct, pattern, watermarks, window_functions
from tidemark.operators.pattern import Pattern
from tidemark.sinks.versioned import MOST_CHANGES, VersionedTable
from tidemark.streaming import stateful as st, triggers
from tidemark.streaming.lateness import late_windows_writer

SCHEMA = "k string, seq bigint, v string"


def versioned(spark, path):
    return VersionedTable(spark, str(path), ["k"], "seq", SCHEMA)


def test_table_stays_bounded_over_many_batches(spark, tmp_path):
    t, want, largest = versioned(spark, tmp_path / "t"), {}, 0
    rng = random.Random(1)
    for batch in range(50):  # one small commit each
        data = [(f"k{rng.randrange(30)}", batch * 100 + i, f"v{batch}-{i}") for i in range(10)]
        want |= {k: v for k, _, v in data}
        t.merge(spark.createDataFrame(data, SCHEMA), batch)
        largest = max(largest, len(storage.names(spark, f"{t.path}/data")))
    assert rows(t.read(), "k", "v") == sorted(want.items())
    assert largest <= 2 * (MOST_CHANGES + 2) and len(t.versions()) == 2


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    t = versioned(spark, tmp_path / "t")
    for batch in range(3):
        t.merge(spark.createDataFrame([("a", batch, str(batch)), ("a", batch, "0"), (None, batch, "n")], SCHEMA), batch)
    before, files = rows(t.read()), storage.names(spark, f"{t.path}/data")
    t.merge(spark.createDataFrame([("a", 99, "other")], SCHEMA), 2)
    assert rows(t.read()) == before == [("a", 2, "2"), (None, 2, "n")]
    assert storage.names(spark, f"{t.path}/data") == files
    assert rows(t.read(before=2)) == [("a", 1, "1"), (None, 1, "n")]


def test_a_writer_that_dies_leaves_the_version_before(spark, tmp_path):
    t = versioned(spark, tmp_path / "t")
    t.merge(spark.createDataFrame([("a", 1, "x")], SCHEMA), 0)
    spark.createDataFrame([("a", 2, "y")], SCHEMA).write.parquet(f"{t.path}/data/changes-1-dead")
    assert rows(t.read()) == [("a", 1, "x")]
    t.merge(spark.createDataFrame([("a", 3, "z")], SCHEMA), 1)
    assert rows(t.read()) == [("a", 3, "z")] and "changes-1-dead" not in storage.names(spark, f"{t.path}/data")


def test_a_reader_keeps_its_version(spark, tmp_path):
    t = versioned(spark, tmp_path / "t")
    t.merge(spark.createDataFrame([("a", 1, "x")], SCHEMA), 0)
    opened = t.read()
    t.merge(spark.createDataFrame([("a", 2, "y"), ("b", 2, "y")], SCHEMA), 1)
    assert rows(opened) == [("a", 1, "x")] and rows(t.read()) == [("a", 2, "y"), ("b", 2, "y")]


ARRIVALS = "k string, arr bigint, id bigint, us bigint"


def run_batches(spark, path, batches, again=(), **options):
    write = late_windows_writer(str(path), {"k": "string"}, ["arr", "id"], **options)
    for number, data in enumerate(batches):
        for _ in range(2 if number in again else 1):
            write(spark.createDataFrame(data, ARRIVALS), number)


def by_hand(data, delay, size, lateness):
    """One row after the other."""
    top, counts, out, late = None, {}, [], []
    for k, arr, i, us in sorted(data, key=lambda r: (r[1], r[2])):
        wm = None if top is None else top - delay - 1
        end = us - us % size + size
        c = counts.setdefault((k, end), [0, 0])
        if wm is None or end - 1 > wm:
            c[0] += 1
        elif end - 1 + lateness > wm:
            c[1] += 1
            out.append((k, end, c[1], c[0] + c[1], "first" if c == [0, 1] else "refire"))
        else:
            late.append((k, end, i))
        top = us if top is None else max(top, us)
    out += [(k, end, 0, n, "first") for (k, end), (n, _) in counts.items() if n and end - 1 <= top - delay - 1]
    return sorted(out, key=repr), sorted(late, key=repr)


@pytest.mark.parametrize("cuts", [1, 5])
@pytest.mark.parametrize("lateness", [0, 25])
def test_lateness_does_not_depend_on_micro_batches(spark, tmp_path, cuts, lateness):
    rng = random.Random(cuts)
    data = [(rng.choice(["a", "a", "a", "b", None]), n, n, max(0, n * 3 - rng.randrange(90))) for n in range(160)]
    size, delay = 20, 15
    step = -(-len(data) // cuts)
    parts = [data[a : a + step] for a in range(0, len(data), step)]
    run_batches(spark, tmp_path, parts, again={1, cuts - 1}, delay=delay, size=size, lateness=lateness)
    fired = spark.read.parquet(f"{tmp_path}/fired")
    late = spark.read.parquet(f"{tmp_path}/late")
    want = by_hand(data, delay, size, lateness)
    assert rows(fired, "k", "window_end", "fire", "cnt", "kind") == want[0]
    assert rows(late, "k", "window_end", "id") == want[1] and want[1]
    state = VersionedTable(spark, f"{tmp_path}/state", ["k", "window_end"], "batch", "k string, window_end bigint, batch bigint, on_time bigint, accepted bigint, fired boolean")
    assert state.read().count() < len({(k, us // size) for k, _, _, us in data}) or cuts == 1


def test_lateness_equals_the_batch_form(spark, tmp_path):
    rng = random.Random(5)
    data = [("a", n, n, max(0, n * 2 - rng.randrange(60))) for n in range(200)] + [("end", 1000, 1000, 10**9)]
    run_batches(spark, tmp_path, [data[:70], data[70:150], data[150:]], delay=10, size=16, lateness=20)
    batch = watermarks.allowed_lateness(spark.createDataFrame(data, ARRIVALS), ["k"], ["arr", "id"], 10, 16, 20)
    fired = spark.read.parquet(f"{tmp_path}/fired")
    want = batch.filter("kind <> 'side_output' AND k <> 'end'")
    names = ("k", "window_end", "fire", "cnt", "kind")
    assert rows(fired, *names) == rows(want, *names)


def test_carried_files_stay_two(spark, tmp_path):
    run_batches(spark, tmp_path, [[("a", n, n, n * 10)] for n in range(6)], delay=0, size=10)
    assert len(storage.names(spark, f"{tmp_path}/seen")) == 2
    assert json.loads(storage.read_text(spark, f"{tmp_path}/seen/{5:012d}.json")) == [50]


def test_an_empty_first_batch(spark, tmp_path):
    run_batches(spark, tmp_path, [[], [("a", 1, 1, 5)], [], [("a", 2, 2, 95)]], delay=0, size=10)
    assert rows(spark.read.parquet(f"{tmp_path}/fired"), "k", "window_end", "cnt") == [("a", 10, 1)]


# ---------------------------------------------------------------- triggers


class R(dict):
    __getattr__ = dict.__getitem__


def drive(automaton, times, upto):
    s, out = automaton.begin(), []

    def clock(limit):
        nonlocal s
        while (t := automaton.deadline(s)) is not None and t <= limit:
            s, more = automaton.fire(s, t)
            out.extend(more)

    for t in times:
        clock(t - 1)
        s, more = automaton.row(s, R(us=t))
        out += more
    clock(upto)
    assert s == automaton.begin() or upto < 10**6
    return out


def test_triggers_on_window_state():
    times = [1, 4, 5, 12, 13, 14, 15, 31]
    assert drive(triggers.Triggered(10, triggers.AtEnd()), times, 10**6) == [(0, 9, 3), (10, 19, 4), (30, 39, 1)]
    assert drive(triggers.Triggered(10, triggers.EveryN(2)), times, 10**6) == [(0, 4, 2), (10, 13, 2), (10, 15, 2)]
    early = [(0, 3, 1), (0, 6, 3), (0, 9, 3), (0, 9, 3), (10, 15, 4), (10, 18, 4), (10, 19, 4), (30, 33, 1), (30, 36, 1), (30, 39, 1), (30, 39, 1)]
    assert sorted(set(drive(triggers.Triggered(10, triggers.Early(3)), times, 10**6))) == sorted(set(early))


def test_a_purge_without_firing_forgets_and_a_purged_window_is_silent():
    class Forget(triggers.Trigger):
        def on_element(self, mark, us, window):
            return mark, triggers.PURGE

        def on_time(self, mark, us, window):
            return mark, triggers.FIRE

    assert drive(triggers.Triggered(10, Forget()), [1, 2, 11], 10**6) == []


# ---------------------------------------------------------------- user functions over windows


def test_window_accumulator_and_process_function(spark):
    class Range(window_functions.Accumulator):
        sql_type = "array<bigint>"

        def create(self):
            return []

        def add(self, acc, elements):
            assert isinstance(elements, pd.DataFrame)
            return self.merge(acc, [int(elements["v"].min()), int(elements["v"].max()), len(elements)])

        def merge(self, a, b):
            return list(b) if not len(a) else list(a) if not len(b) else [min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2]]

    data = [("a" if n % 3 else None, n, (n * 37) % 101) for n in range(500)]
    df = spark.createDataFrame(data, "k string, us bigint, v bigint").repartition(6)

    def finish(key, start, end, acc):
        return [(acc[1] - acc[0], acc[2])] * (end // 100)  # as many rows as it likes

    got = window_functions.aggregate_window(df, ["k"], 100, ["v"], Range(), finish, "spread bigint, n bigint")
    groups = {}
    for k, us, v in data:
        groups.setdefault((k, us // 100 * 100), []).append(v)
    want = [(k, s, s + 100, max(v) - min(v), len(v)) for (k, s), v in groups.items() for _ in range((s + 100) // 100)]
    assert rows(got) == sorted(want, key=repr)

    def order(key, start, end, elements):
        seen = [v for batch in elements for v in batch["v"]]
        return [(",".join(map(str, seen)),)]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = rows(window_functions.process_window(df, ["k"], 100, ["v"], order, "seen string"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(((k, s, s + 100, ",".join(map(str, v))) for (k, s), v in groups.items()), key=repr)
    empty = df.filter("v < 0")
    assert window_functions.process_window(empty, ["k"], 100, ["v"], order, "seen string").count() == 0


# ---------------------------------------------------------------- patterns


def by_eye(data, want, within):
    out = []
    for i in range(len(data)):
        k = 0
        while k < len(want) and i + k < len(data) and want[k](data[i + k][1]) and (not k or data[i + k][0] - data[i][0] < within):
            k += 1
        if k == len(want):
            out.append((data[i][0], "match", k))
        elif k and (i + k == len(data) or data[i + k][0] - data[i][0] >= within):
            out.append((data[i][0], "timeout", k))
    return sorted(out)


def test_pattern_matches_as_maps(spark):
    rng = random.Random(3)
    t, data = 0, []
    for _ in range(120):
        t += rng.choice([1, 2, 9])
        data.append((t, rng.choice("ab")))
    df = spark.createDataFrame([("x", us, kind) for us, kind in data], "k string, us bigint, kind string")
    p = Pattern.begin("as", F.col("kind") == "a").times(2).next("b", F.col("kind") == "b").within(8)
    got = p.match(df, ["k"], ["us"], ["us", "kind"])
    flat = got.select(F.col("match")["as"][0]["us"], "tag", F.size(F.flatten(F.map_values("match"))))
    is_a, is_b = (lambda c: c == "a"), (lambda c: c == "b")
    assert rows(flat) == sorted(by_eye(data, [is_a, is_a, is_b], 8), key=repr)
    each = pattern.select_each(got, F.flatten(F.map_values("match")), ["tag"])
    assert each.count() == sum(n for _, _, n in by_eye(data, [is_a, is_a, is_b], 8))
    one = Pattern.begin("only", F.col("kind") == "a").match(df, ["k"], ["us"], ["us"])
    assert one.count() == sum(k == "a" for _, k in data)
    with pytest.raises(ValueError):
        p.next("b", F.lit(True))


def test_count_windows_keep_no_rows():
    """State of the hand-made window is one number per open window."""
    assert [f for f in vars(st.CountWindows) if f.startswith("handle")] == ["handleInputRows", "handleExpiredTimer"]
    seen = {}

    class Map:
        def containsKey(self, k):
            return k in seen

        def getValue(self, k):
            return seen[k]

        def updateValue(self, k, v):
            seen[k] = v

        def removeKey(self, k):
            del seen[k]

    timers = []
    p = st.CountWindows(10_000, "us", "k string, salt int, window_start bigint, cnt bigint")
    p.handle = type("H", (), {"registerTimer": lambda self, t: timers.append(t)})()
    p.counts = Map()
    for _ in range(3):
        assert list(p.handleInputRows(("a", 1), iter([R(us=u) for u in range(0, 30_000, 10)]), None)) == []
    assert seen == {(0,): (3000,), (10_000,): (3000,), (20_000,): (3000,)} and timers == [10, 20, 30]
    info = type("I", (), {"getExpiryTimeInMs": lambda self: 10})()
    assert [tuple(r) for r in p.handleExpiredTimer(("a", 1), None, info)] == [("a", 1, 0, 3000)] and len(seen) == 2


# ---------------------------------------------------------------- bit sets


def test_bit_sets_never_count_too_many_and_merge(spark):
    n = 60_000
    df = spark.range(3 * n).select((F.col("id") % n).alias("who"), F.lit("x").alias("k"))
    sets = distinct.bloom_sets(df, [F.col("k")], "who", expected=n, error=0.01)
    got = distinct.bloom_count(sets, 1).first()["uv"]
    assert 0.985 * n <= got <= n
    halves = [distinct.bloom_sets(df.filter(F.col("who") % 2 == r), [F.col("k")], "who", expected=n, error=0.01) for r in (0, 1)]
    assert distinct.bloom_count(halves[0].unionByName(halves[1]), 1).first()["uv"] == got
    assert sets.select(F.length("bits")).distinct().collect() == [(4096,)]
    crowded = distinct.bloom_count(distinct.bloom_sets(df, [F.col("k")], "who", expected=1000, error=0.01), 1).first()["uv"]
    assert crowded <= distinct.bloom_bits(1000, 0.01) < n
    assert distinct.bloom_sets(df.filter("who < 0"), [F.col("k")], "who").count() == 0
