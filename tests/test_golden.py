"""Small worked cases with known answers, through the batch operators."""

from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.functions.clock import SECOND, idiv
from tidemark.functions.text import behavior_row, key_ts_row
from tidemark.operators import changelog, distribution, joins, patterns, topn, watermarks, windows
from tidemark.operators.ordered import running
from tidemark.operators.rows import replicate, tokenize
from tidemark.sources.files import declare_table

S = SECOND
MS = 1000


@pytest.fixture(scope="module")
def five(spark):
    return spark.createDataFrame([(i, i) for i in range(1, 6)], "seq bigint, x bigint")


def test_word_count_rolling_and_final(spark):
    lines = spark.createDataFrame([(0, "hello world"), (1, "hello world")], "line bigint, text string")
    words = tokenize(lines)
    rolling = running(words, ["word"], ["line", "pos"], {"n": ("count", F.lit(1))}).orderBy("line", "pos")
    assert [(r.word, r.n) for r in rolling.collect()] == [("hello", 1), ("world", 1), ("hello", 2), ("world", 2)]
    assert rows(words.groupBy("word").count()) == [("hello", 2), ("world", 2)]


@pytest.mark.parametrize(
    "text,want",
    [("a b", ["a", "b"]), ("a  b ", ["a", "", "b"]), ("", [""]), ("   ", []), (" a", ["", "a"]), ("a.b c", ["a.b", "c"])],
)
def test_token_edges(spark, text, want):
    got = tokenize(spark.createDataFrame([(text,)], "text string")).orderBy("pos")
    assert [r.word for r in got.collect()] == want


def test_replicate(spark):
    colours = spark.createDataFrame([("white",), ("black",), ("gray",)], "c string")
    times = F.when(F.col("c") == "white", 1).when(F.col("c") == "black", 2).otherwise(0)
    assert rows(replicate(colours, times), "c") == [("black",), ("black",), ("white",)]


def test_rolling_sums(five):
    parity = running(five.withColumn("p", F.col("x") % 2), ["p"], ["seq"], {"s": ("sum", F.col("x"))})
    assert [r[1] for r in rows(parity, "seq", "s")] == [1, 2, 4, 6, 9]
    assert [r[1] for r in rows(running(five, [], ["seq"], {"s": ("sum", F.col("x"))}), "seq", "s")] == [1, 3, 6, 10, 15]


def test_rolling_min_max_and_integer_average(five):
    x = F.col("x")
    aggs = {"lo": ("min", x), "hi": ("max", x), "s": ("sum", x), "n": ("count", x)}
    got = running(five, [], ["seq"], aggs).withColumn("avg", idiv(F.col("s"), F.col("n")))
    assert rows(got, "seq", "lo", "hi", "avg") == [(1, 1, 1, 1), (2, 1, 2, 1), (3, 1, 3, 2), (4, 1, 4, 2), (5, 1, 5, 3)]


def test_integer_quotient_truncates(spark):
    got = spark.range(1).select(*[idiv(F.lit(a), b).alias(f"q{i}") for i, (a, b) in enumerate([(3, 2), (15, 5), (-3, 2)])])
    assert rows(got) == [(1, 3, -1)]


def test_distribution(spark):
    four = spark.range(1, 5)
    each = [(i,) for i in range(1, 5)]
    assert rows(distribution.to_every(four, 2), "id") == sorted(each * 2)
    for moved in (
        distribution.shuffle(four, 2, "id"),
        distribution.rebalance(four, 2),
        distribution.by_key(four, 2, "id"),
        distribution.rescale(four.coalesce(1), 2),
    ):
        assert rows(moved) == each
        assert moved.rdd.getNumPartitions() == 2
    assert distribution.rescale(four.repartition(4), 2).rdd.getNumPartitions() == 2
    assert rows(distribution.by_key(four, 2, "id", split_hot=True)) == each


def test_subtask_placement(spark):
    placed = distribution.to_subtask(spark.range(1, 9), 2, F.col("id") % 2)
    got = rows(placed.select("id", "subtask", F.spark_partition_id().alias("p")))
    assert got == [(i, i % 2, i % 2) for i in range(1, 9)]


def test_sessions(spark):
    ones = spark.createDataFrame([("a", t * S) for t in (0, 1, 2, 12)], "k string, us bigint")
    assert rows(windows.sessions(ones, ["k"], 5 * S)) == [("a", 0, 7 * S, 3), ("a", 12 * S, 17 * S, 1)]
    touching = spark.createDataFrame([("a", t * S) for t in (0, 5, 11)], "k string, us bigint")
    assert rows(windows.sessions(touching, ["k"], 5 * S), "cnt") == [(1,), (2,)]


def test_tumbling(spark):
    rows_ = spark.createDataFrame([("a", t) for t in (1, 2, 10)], "k string, t bigint")
    timed = rows_.select("k", F.timestamp_seconds("t").alias("ts"), (F.col("t") * S).alias("us"))
    want = [("a", 0, 5 * S, 2), ("a", 10 * S, 15 * S, 1)]
    assert rows(windows.tumbling(timed, ["k"], 5 * S, [F.count("*").alias("cnt")])) == want
    assert rows(windows.tumbling_by_hand(timed, ["k"], 5 * S), "k", "window_start", "window_end", "cnt") == want


def test_sliding_panes_equal_expanded_windows(spark):
    data = spark.range(400).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 * S).alias("us"))
    data = data.withColumn("ts", F.timestamp_micros("us"))
    for size, slide in ((3600, 300), (600, 600), (1000, 300)):
        grouped = data.groupBy("k", F.window("ts", f"{size} seconds", f"{slide} seconds").alias("window"))
        want = grouped.agg(F.count("*").alias("cnt")).select("k", *windows.bounds(), "cnt")
        assert rows(windows.sliding_counts(data, ["k"], size * S, slide * S)) == rows(want)


def test_top_n_emits_what_exists_and_breaks_ties(spark):
    counts = spark.createDataFrame(
        [(0, "b", 5), (0, "a", 5), (0, "c", 9), (0, "d", 1), (1, "z", 2)], "w bigint, item string, cnt bigint"
    )
    got = topn.top_n(counts, ["w"], [F.col("cnt").desc(), F.col("item")], 3)
    assert rows(got, "w", "rank", "item") == [(0, 1, "c"), (0, 2, "a"), (0, 3, "b"), (1, 1, "z")]
    assert rows(topn.top1(counts, ["w"], "item", "cnt")) == [(0, "c", 9), (1, "z", 2)]


FAILS = [("u1", "fail", 1000), ("u2", "success", 2000), ("u1", "fail", 3000), ("u1", "fail", 4000), ("u1", "fail", 5000)]


def history(spark, data):
    return spark.createDataFrame(data, "k string, type string, ms bigint").withColumn("us", F.col("ms") * MS)


def test_three_failures(spark):
    is_fail = F.col("type") == "fail"
    got = patterns.repeats(history(spark, FAILS), ["k"], ["us"], is_fail, 3)
    assert rows(got, "k", "ms") == [("u1", 4000), ("u1", 5000)]
    reset = history(spark, [("u", t, i) for i, t in enumerate(["fail", "fail", "odd", "fail", "fail", "fail"])])
    assert rows(patterns.repeats(reset, ["k"], ["us"], is_fail, 3), "ms") == [(5,)]


def test_strict_sequence_keeps_overlaps(spark):
    fail = lambda row: row("type") == "fail"
    stages = [("a", fail), ("b", fail), ("c", fail)]
    got = patterns.match_recognize(history(spark, FAILS), ["k"], ["us"], stages, ["ms"])
    assert rows(got, "a_ms", "b_ms", "c_ms") == [(1000, 3000, 4000), (3000, 4000, 5000)]
    seven = history(spark, [("u1", "fail", t) for t in (1000, 3000, 4000, 5000, 6000, 7000, 8000)])
    assert patterns.repeats(seven, ["k"], ["us"], F.col("type") == "fail", 3).count() == 5


ORDERS = [("order-1", "create", 1000), ("order-1", "pay", 4000), ("order-2", "create", 2000), ("order-2", "pay", 9000)]


def test_within_and_timeout(spark):
    stages = [("create", lambda row: row("type") == "create"), ("pay", lambda row: row("type") == "pay")]
    got = patterns.match_recognize(history(spark, ORDERS), ["k"], ["us"], stages, ["ms"], within=5 * S)
    assert rows(got, "k", "create_ms", "pay_ms", "tag") == [
        ("order-1", 1000, 4000, "match"),
        ("order-2", 2000, None, "timeout"),
    ]
    edge = history(spark, [("x", "create", 0), ("x", "pay", 5000), ("y", "create", 0), ("y", "other", 10)])
    assert rows(patterns.match_recognize(edge, ["k"], ["us"], stages, ["ms"], within=5 * S), "k", "tag") == [("x", "timeout")]


def test_within_covers_the_whole_sequence(spark):
    stages = [(n, lambda row, n=n: row("type") == n) for n in "abc"]
    data = [("p", "a", 0), ("p", "b", 2), ("p", "c", 9), ("q", "a", 0), ("q", "b", 2), ("r", "a", 0), ("r", "b", 1), ("r", "c", 2)]
    got = patterns.match_recognize(history(spark, data), ["k"], ["us"], stages, ["ms"], within=5 * MS)
    assert rows(got, "k", "a_ms", "b_ms", "c_ms", "tag") == [
        ("p", 0, 2, None, "timeout"), ("q", 0, 2, None, "timeout"), ("r", 0, 1, 2, "match")
    ]


def test_order_timeout(spark):
    kind = F.col("type")
    got = patterns.order_timeouts(history(spark, ORDERS), ["k"], kind == "create", kind == "pay", 5 * S)
    assert rows(got) == [
        ("order-1", 4 * S, "paid"),
        ("order-2", 7 * S, "timeout"),
        ("order-2", 9 * S, "paid"),
    ]
    on_time = history(spark, [("x", "create", 0), ("x", "pay", 5000)])
    assert rows(patterns.order_timeouts(on_time, ["k"], kind == "create", kind == "pay", 5 * S), "tag") == [("paid",)]


def test_inner_join(spark):
    a = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 4)], "k string, v int")
    b = spark.createDataFrame([("a", 5), ("a", 6), ("b", 7), ("b", 8)], "k string, w int")
    want = [("a", x, y) for x in (1, 2) for y in (5, 6)] + [("b", x, y) for x in (3, 4) for y in (7, 8)]
    assert rows(joins.inner_join(a, b, ["k"])) == want
    assert rows(joins.matches_per_key(a, b, "k")) == [("a", 4), ("b", 4)]


def minutes(hhmm):
    return (int(hhmm[:2]) * 60 + int(hhmm[3:])) * 60 * S


def test_interval_join(spark):
    orders = spark.createDataFrame([("m", minutes(t)) for t in ("12:10", "13:00")], "k string, o bigint")
    clicks = spark.createDataFrame([("m", minutes(t)) for t in ("11:20", "12:15", "13:25")], "k string, c bigint")
    got = joins.interval_join(orders, clicks, ["k"], "o", "c", 3600 * S, 900 * S)
    want = [("12:10", "11:20"), ("12:10", "12:15"), ("13:00", "12:15")]
    assert rows(got, "o", "c") == [(minutes(a), minutes(b)) for a, b in want]
    edges = spark.createDataFrame([("m", t) for t in (0, 3600 * S, 4500 * S, 4501 * S)], "k string, c bigint")
    one = spark.createDataFrame([("m", 3600 * S)], "k string, o bigint")
    assert rows(joins.interval_join(one, edges, ["k"], "o", "c", 3600 * S, 900 * S), "c") == [(0,), (3600 * S,), (4500 * S,)]


def test_window_join(spark):
    a = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("b", 2)], "k string, l bigint").withColumn("l", F.col("l") * S)
    b = spark.createDataFrame([("a", 3), ("b", 3), ("a", 4), ("b", 4)], "k string, r bigint").withColumn("r", F.col("r") * S)
    got = joins.window_join(a, b, ["k"], "l", "r", 5 * S)
    assert rows(got.groupBy("k").count()) == [("a", 4), ("b", 4)]


def test_gate(spark):
    opened = spark.createDataFrame([("s1", 0)], "k string, us bigint")
    data = spark.createDataFrame(
        [(k, t * S, f"{k}@{t}") for k in ("s1", "s2") for t in (0, 5, 10, 11)], "k string, us bigint, name string"
    )
    assert rows(joins.gate(data, opened, ["k"], "us", 10 * S), "name") == [("s1@0",), ("s1@5",)]
    twice = spark.createDataFrame([("s1", 0), ("s1", 6 * S)], "k string, us bigint")
    # the first opening's end closes the gate although it was opened again meanwhile
    assert rows(joins.gate(data, twice, ["k"], "us", 10 * S), "name") == [("s1@0",), ("s1@5",)]


def test_reconcile(spark):
    app = spark.createDataFrame([("order-1", 1000), ("order-2", 2000)], "id string, l bigint")
    bank = spark.createDataFrame([("order-1", 4000), ("order-2", 9000)], "id string, r bigint")
    got = joins.reconcile(app, bank, ["id"], "l", "r", 5000)
    assert rows(got, "id", "l", "r", "outcome") == [
        ("order-1", 1000, 4000, "left_first"),
        ("order-2", 2000, None, "left_only"),
        ("order-2", None, 9000, "right_only"),
    ]


def test_changelog(spark):
    clicks = spark.createDataFrame(list(enumerate(["Mary", "Bob", "Mary", "Liz"])), "seq bigint, user string")
    got = changelog.count_changes(clicks, ["user"], ["seq"])
    assert rows(got, "seq", "row_kind", "user", "cnt") == [
        (0, "+I", "Mary", 1),
        (1, "+I", "Bob", 1),
        (2, "+U", "Mary", 2),
        (2, "-U", "Mary", 1),
        (3, "+I", "Liz", 1),
    ]
    assert rows(changelog.replay(got, ["user"])) == [("Bob", 1), ("Liz", 1), ("Mary", 2)]


def test_parsing(spark):
    line = spark.createDataFrame([("543462,1715,1464116,pv,1511658000",)], "line string")
    assert rows(line.select(*behavior_row(F.col("line")))) == [("543462", "1715", "1464116", "pv", 1511658000 * S)]
    assert rows(spark.createDataFrame([("a 3",)], "line string").select(*key_ts_row(F.col("line")))) == [("a", 3 * S)]


def test_csv_table(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Mary,./home\nBob,./cart\nMary,./prod?id=1\nLiz,./home\n")
    declare_table(spark, "golden_clicks", "`user` string, url string", "csv", str(tmp_path))
    got = spark.sql("SELECT user, count(url) AS cnt FROM golden_clicks GROUP BY user")
    assert rows(got) == [("Bob", 1), ("Liz", 1), ("Mary", 2)]
    declare_table(spark, "golden_clicks", "`user` string, url string", "csv", str(tmp_path))
    spark.sql("CREATE TABLE golden_foreign (a int) USING csv OPTIONS ('path' '%s')" % tmp_path)
    with pytest.raises(ValueError):
        declare_table(spark, "golden_foreign", "b int", "csv", str(tmp_path))
    spark.sql("DROP TABLE golden_foreign")


def test_watermark_trace(spark):
    data = spark.createDataFrame([(0, 1 * S), (1, 9 * S), (2, 3 * S), (3, 12 * S)], "seq bigint, us bigint")
    got = watermarks.watermark_trace(data, ["seq"], 5 * S)
    assert rows(got, "seq", "wm_before", "wm_after") == [
        (0, None, -4 * S - 1),
        (1, -4 * S - 1, 4 * S - 1),
        (2, 4 * S - 1, 4 * S - 1),
        (3, 4 * S - 1, 7 * S - 1),
    ]
    late = watermarks.with_watermark_before(data, ["seq"], 5 * S).filter(watermarks.late())
    assert rows(late, "seq") == [(2,)]


def test_element_timers_fire_once_per_instant(spark):
    data = spark.createDataFrame([("a", 0), ("a", 0), ("a", 5), ("b", 20)], "k string, us bigint")
    got = watermarks.element_timers(data, ["k"], 10)
    assert rows(got) == [("a", 10, True), ("a", 15, True), ("b", 30, False)]
