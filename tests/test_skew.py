"""The chunked paths against brute force, with one key holding most rows and tiny chunks."""

from __future__ import annotations

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import joins, patterns, watermarks, windows
from tidemark.operators.ordered import cut, running, shifted

SPLIT = {"target_rows": 40}


def skewed(n=1200, seed=1, keys=9, gap=1000):
    """(key, us, id, v): key 0 has about half of the rows, key None a few."""
    rng = random.Random(seed)
    us, out = 0, []
    for i in range(n):
        us += rng.randint(1, gap)
        key = rng.choice([0, 0, 0, 0, rng.randint(1, keys), None if rng.random() < 0.1 else 1])
        out.append((key, us, i, None if rng.random() < 0.05 else rng.randint(0, 20)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    plain = skewed()
    return plain, spark.createDataFrame(plain, "k int, us bigint, id bigint, v int").repartition(5, "id").cache()


def by_key(plain, use_key=True):
    groups = {}
    for row in sorted(plain, key=lambda r: r[1]):
        groups.setdefault(row[0] if use_key else None, []).append(row)
    return groups


def test_cut_splits_only_hot_keys_and_keeps_order(data):
    plain, df = data
    c = cut(df, ["k"], ["us"], **SPLIT)
    assert c.split
    sizes = {(r["k"], r["__chunk"]): r["count"] for r in c.rows.groupBy("k", "__chunk").count().collect()}
    assert sum(sizes.values()) == len(plain)
    hot = [s for (k, _), s in sizes.items() if k == 0]
    assert len(hot) > 5 and max(hot) < 6 * SPLIT["target_rows"]
    spans = c.rows.filter("k = 0").groupBy("__chunk").agg(F.min("us").alias("a"), F.max("us").alias("b"))
    ends = [(r["a"], r["b"]) for r in spans.orderBy("__chunk").collect()]
    assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


@pytest.mark.parametrize("use_key", [True, False])
@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("order", [["us"], ["us", "id"]])
def test_running_equals_brute_force(data, use_key, before, order):
    plain, df = data
    v = F.col("v")
    aggs = {"n": ("count", v), "s": ("sum", v), "lo": ("min", v), "hi": ("max", v), "last": ("last", v)}
    got = running(df, ["k"] if use_key else [], order, aggs, before=before, **SPLIT)
    want = []
    for group in by_key(plain, use_key).values():
        for i, row in enumerate(group):
            seen = [r[3] for r in group[: i + (not before)] if r[3] is not None]
            tail = (sum(seen), min(seen), max(seen), seen[-1]) if seen else (None,) * 4
            want.append((row[2], len(seen), *tail))
    assert rows(got, "id", "n", "s", "lo", "hi", "last") == sorted(want, key=repr)


@pytest.mark.parametrize("use_key", [True, False])
def test_shifted_equals_brute_force(data, use_key):
    plain, df = data
    outputs = {"b1": ("v", -1), "b3": ("id", -3), "a1": ("us", 1), "a2": ("v", 2)}
    got = shifted(df, ["k"] if use_key else [], ["us"], outputs, **SPLIT)
    want = []
    for g in by_key(plain, use_key).values():
        for i, row in enumerate(g):
            at = lambda j, c: g[j][c] if 0 <= j < len(g) else None
            want.append((row[2], at(i - 1, 3), at(i - 3, 2), at(i + 1, 1), at(i + 2, 3)))
    assert rows(got, "id", "b1", "b3", "a1", "a2") == sorted(want, key=repr)


def test_shifted_with_chunks_smaller_than_the_offset(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("us"))
    got = shifted(df, ["k"], ["us"], {"b": ("us", -7), "a": ("us", 7)}, target_rows=2)
    want = [(i, i - 7 if i >= 7 else None, i + 7 if i < 193 else None) for i in range(200)]
    assert rows(got, "us", "b", "a") == sorted(want, key=repr)


def brute_sessions(plain, gap):
    out = []
    for key, group in by_key(plain).items():
        start = last = None
        for _, us, *_ in group:
            if last is None or us - last > gap:
                if last is not None:
                    out.append((key, start, last + gap, n))
                start, n = us, 0
            last, n = us, n + 1
        out.append((key, start, last + gap, n))
    return out


@pytest.mark.parametrize("gap", [1, 700, 1500, 9000])
def test_sessions(data, gap):
    plain, df = data
    plain = [r for r in plain if r[0] is not None]
    got = windows.sessions(df.filter("k is not null"), ["k"], gap)
    assert rows(got) == sorted(brute_sessions(plain, gap), key=repr)


@pytest.mark.parametrize("size,tick", [(10_000, 2_500), (9_000, 2_000), (5_000, 5_000)])
def test_early_fires(data, size, tick):
    plain, df = data
    want, panes = [], {}
    for key, us, *_ in plain:
        panes.setdefault((key, us // size * size), []).append(us)
    for (key, ws), times in panes.items():
        t = min(times) // tick * tick + tick
        while t < ws + size:
            want.append((key, ws, t, sum(x <= t for x in times)))
            t += tick
        want.append((key, ws, ws + size - 1, len(times)))
    assert rows(windows.early_fires(df, ["k"], size, tick)) == sorted(want, key=repr)


def test_interval_join(data):
    plain, df = data
    a = df.filter("v < 6").selectExpr("k", "us as l", "id as lid")
    b = df.filter("v > 12").selectExpr("k", "us as r", "id as rid")
    got = joins.interval_join(a, b, ["k"], "l", "r", 5000, 1200)
    left = [r for r in plain if r[3] is not None and r[3] < 6]
    right = [r for r in plain if r[3] is not None and r[3] > 12]
    want = [
        (x[2], y[2]) for x in left for y in right
        if x[0] is not None and x[0] == y[0] and x[1] - 5000 <= y[1] <= x[1] + 1200
    ]
    assert rows(got, "lid", "rid") == sorted(want, key=repr)


def brute_rising(plain, hold):
    """Record at a time: a timer due before a row has fired before it."""
    out = []
    for key, group in by_key(plain).items():
        last = due = None
        for _, us, _, v in group:
            if due is not None and due < us:
                out.append((key, due))
                due = None
            if last is not None:
                if v < last:
                    due = None
                elif v > last and due is None:
                    due = us + hold
            last = v
        if due is not None:
            out.append((key, due))
    return out


@pytest.mark.parametrize("hold", [500, 3000, 20_000])
@pytest.mark.parametrize("shape", ["random", "climbing"])
@pytest.mark.parametrize("limit", [3, 100_000])
def test_rising_alerts(spark, hold, shape, limit):
    rng = random.Random(hold)
    plain = [(k or 0, us, i, v or 0) for k, us, i, v in skewed(600, seed=3)]
    if shape == "climbing":
        climb, out = {}, []
        for k, us, i, _ in plain:
            climb[k] = climb.get(k, 0) + (rng.choice([0, 1, 1, 2]) if rng.random() > 0.01 else -5)
            out.append((k, us, i, climb[k]))
        plain = out
    df = spark.createDataFrame(plain, "k int, us bigint, id bigint, v int")
    got = patterns.rising_alerts(df, ["k"], ["us"], "v", hold, longest_fold=limit, **SPLIT)
    assert rows(got) == sorted(brute_rising(plain, hold), key=repr)


def test_allowed_lateness_by_record(spark):
    rng = random.Random(5)
    size, delay, lateness = 5000, 2000, 3000
    plain = [(rng.choice("ab"), max(0, i * 100 + rng.randint(-9000, 0)), i) for i in range(500)]
    df = spark.createDataFrame(plain, "k string, us bigint, id bigint")
    got = watermarks.allowed_lateness(df, ["k"], ["id"], delay, size, lateness)
    counts, fired, dropped, want, wm, seen = {}, {}, {}, [], None, None
    for k, us, _ in plain:
        win = (k, us // size * size + size)
        last = win[1] - 1
        if wm is None or last > wm:
            counts[win] = counts.get(win, 0) + 1
        elif last + lateness > wm:
            counts[win] = counts.get(win, 0) + 1
            fired.setdefault(win, []).append(counts[win])
        else:
            dropped[win] = dropped.get(win, 0) + 1
        seen = us if seen is None else max(seen, us)
        wm = seen - delay - 1
    for win, total in counts.items():
        again = fired.get(win, [])
        on_time = total - len(again)
        if on_time:
            want.append((*win, 0, on_time, "first"))
        want += [
            (*win, n, on_time + n, "first" if not on_time and n == 1 else "refire") for n in range(1, len(again) + 1)
        ]
    want += [(*win, None, n, "side_output") for win, n in dropped.items()]
    assert rows(got, "k", "window_end", "fire", "cnt", "kind") == sorted(want, key=repr)


def test_latest_control_takes_the_newest_at_or_before(spark):
    control = spark.createDataFrame([(10, "a"), (20, "b")], "us bigint, want string")
    data_ = spark.createDataFrame([(5, 1), (10, 2), (19, 3), (20, 4), (99, 5)], "us bigint, id int")
    got = joins.latest_control(data_, control, [], "us", "want")
    assert rows(got, "id", "want") == [(1, None), (2, "a"), (3, "a"), (4, "b"), (5, "b")]
