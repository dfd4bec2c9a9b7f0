"""Sources, sinks, user code with a lifecycle, user-defined aggregates, splitting of real queries."""

from __future__ import annotations


import pytest
from check import compare, connect
from helpers import rows
from pyspark.sql import functions as F

from tidemark.functions.clock import DAY
from tidemark.functions.sizing import estimated_bytes, is_small
from tidemark.operators import distinct
from tidemark.operators.rows import custom_aggregate, with_lifecycle
from tidemark.plans.catalog import ORACLES, QUERIES
from tidemark.sinks import writers
from tidemark.sources import custom, network
from tidemark.sources.files import events, table, text_lines, text_lines_stream
from tidemark.streaming.run import Carried, drained, start


def recorded(tmp_path, name, first, n):
    import pyarrow as pa
    import pyarrow.parquet as pq

    ids = list(range(first, first + n))
    table = pa.table(
        {
            "event_id": ids,
            "ts": pa.array(ids, pa.timestamp("us")),
            "user_id": [i % 3 for i in ids],
            "event_type": ["view"] * n,
            "value": [0.5] * n,
            "props": ["{}"] * n,
        }
    )
    pq.write_table(table, tmp_path / "r" / name, row_group_size=100)
    return (tmp_path / "r" / name).stat().st_size


def test_recorded_events_are_read_in_pieces(spark, tmp_path):
    (tmp_path / "r").mkdir()
    size = recorded(tmp_path, "a.parquet", 0, 300)
    custom.register(spark)
    reader = spark.read.format("recorded_events").option("path", str(tmp_path / "r"))
    for piece in (size // 6, size // 2, size + 1):
        df = reader.option("pieceBytes", piece).load()
        assert df.rdd.getNumPartitions() == -(-size // piece)
        assert rows(df, "event_id") == sorted([(i,) for i in range(300)], key=repr)


def test_subtasks_and_copies(spark, tmp_path):
    (tmp_path / "r").mkdir()
    for i in range(5):
        recorded(tmp_path, f"{i}.parquet", i * 100, 100)
    custom.register(spark)
    reader = spark.read.format("recorded_events").option("path", str(tmp_path / "r"))
    own = reader.option("subtasks", 3).load()
    assert own.rdd.getNumPartitions() == 3 and "Exchange" not in own._jdf.queryExecution().toString()
    assert rows(own, F.floor(F.col("event_id") / 100), "subtask") == sorted([(i, i % 3) for i in range(5)] * 100, key=repr)
    twice = spark.read.format("recorded_events").option("path", str(tmp_path / "r")).option("subtasks", 3).option("copies", 2).load()
    assert twice.rdd.getNumPartitions() == 6
    assert rows(twice, "event_id") == sorted([(i,) for i in range(500)] * 2, key=repr)
    spread = spark.read.format("recorded_events").option("path", str(tmp_path / "r")).option("subtasks", 9).load()
    assert spread.rdd.getNumPartitions() == 9 and spread.count() == 500


def test_recorded_stream_goes_on_by_name_when_files_come(spark, tmp_path):
    (tmp_path / "r").mkdir()
    recorded(tmp_path, "b.parquet", 0, 50)
    recorded(tmp_path, "c.parquet", 50, 60)
    custom.register(spark)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = spark.readStream.format("recorded_events").option("path", str(tmp_path / "r")).load()
        query = start(stream.select("event_id"), ck, out, every="100 milliseconds")
        try:
            query.processAllAvailable()
            return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        finally:
            query.stop()

    assert run() == [50, 60]
    recorded(tmp_path, "d.parquet", 110, 70)
    assert run() == [70]
    assert rows(spark.read.parquet(out)) == sorted([(i,) for i in range(180)], key=repr)


def test_text_source_batch_and_stream(spark, tmp_path):
    (tmp_path / "t.txt").write_text("hello world\nhello world\n")
    assert rows(text_lines(spark, str(tmp_path))) == [("hello world",)] * 2
    assert rows(drained(text_lines_stream(spark, str(tmp_path), 1))) == [("hello world",)] * 2


def test_kafka_options():
    got = network.kafka_source_options("h:9092", "clicks", group="g")
    assert got == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "clicks", "startingOffsets": "latest", "kafka.group.id": "g"
    }
    assert writers.kafka_sink_options("h:9092", "out") == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}


def test_kafka_rows(spark):
    df = writers.kafka_rows(spark.range(2), "id")
    assert df.schema.simpleString() == "struct<value:string>" and rows(df) == [("0",), ("1",)]


class FakeConnection:
    """Just enough of a DB-API connection: UPDATE and INSERT on one dictionary."""

    def __init__(self, table, log):
        self.table, self.log, self.rowcount = table, log, 0

    def cursor(self):
        return self

    def execute(self, sql, args):
        self.log.append(sql.split()[0])
        if sql == "UPDATE clicks SET url = ? WHERE username = ?":
            self.rowcount = int(args[1] in self.table)
            if self.rowcount:
                self.table[args[1]] = args[0]
        else:
            assert sql == "INSERT INTO clicks (username, url) VALUES (?, ?)"
            self.table[args[0]] = args[1]

    def commit(self):
        self.log.append("commit")

    def close(self):
        self.log.append("close")


def test_upsert_updates_or_inserts():
    table, log = {"Mary": "./old"}, []
    data = [{"username": "Mary", "url": "./home"}, {"username": "Bob", "url": "./cart"}]
    for _ in range(2):  # a retried task changes nothing
        writers.upsert_rows(data, lambda: FakeConnection(table, log), "clicks", ["username"], ["url"])
    assert table == {"Mary": "./home", "Bob": "./cart"}
    assert log == ["UPDATE", "UPDATE", "INSERT", "commit", "close", "UPDATE", "UPDATE", "commit", "close"]


def test_last_per_key(spark):
    df = spark.createDataFrame([("m", "a", 1), ("b", "x", 2), ("m", "c", 3)], "u string, url string, seq int")
    assert rows(writers.last_per_key(df, ["u"], ["url"], F.col("seq"))) == [("b", "x"), ("m", "c")]


def test_lifecycle_runs_once_per_task(spark, tmp_path):
    log = str(tmp_path / "log")

    def note(what):
        with open(log, "a") as f:
            f.write(what + "\n")

    def square(_, batch):
        return batch.assign(squared=batch["id"] ** 2)

    df = spark.range(1, 5, numPartitions=2)
    got = with_lifecycle(df, "id bigint, squared bigint", lambda: note("open"), square, lambda r: note("close"))
    assert rows(got) == [(1, 1), (2, 4), (3, 9), (4, 16)]
    assert sorted(open(log).read().split()) == ["close", "close", "open", "open"]


def test_custom_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(6)
    got = custom_aggregate(
        df, ["k"], "id", "bigint", lambda acc, v: max(acc, int(v.max())), max, lambda: -1, max_keys_held=1
    )
    assert rows(got) == [(0, 999), (1, 997), (2, 998)]


def test_sketches_merge(spark, folder):
    df = events(spark, folder)
    whole = distinct.uv_sketch(df, 30 * DAY, "event_id").agg(F.sum("uv")).first()[0]
    assert abs(whole - 1000) < 40
    merged = distinct.uv_sketches(df, DAY, "event_id").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch"))).first()[0]
    assert abs(merged - 1000) < 40


def test_carried_value_is_the_one_before(spark, tmp_path):
    carried = Carried(str(tmp_path / "c"), ["top"])
    assert carried.before(spark, 0) is None
    carried.save(spark, 0, (5,))
    carried.save(spark, 1, (7,))
    carried.save(spark, 1, (7,))
    assert carried.before(spark, 1)["top"] == 5 and carried.before(spark, 2)["top"] == 7


def test_size_estimate_is_that_of_the_file(spark, folder):
    import os

    assert estimated_bytes(table(spark, folder, "events")) == os.path.getsize(f"{folder}/events.parquet")
    assert is_small(events(spark, folder))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


BATCH = [n for n in QUERIES if not n.startswith("stream_")]


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", BATCH)
def test_query_equals_sql(spark, folder, db, name):
    assert compare(QUERIES[name](spark, folder), db, ORACLES[name]) == []


SPLIT = [
    "running_word_count", "state_min_max_avg", "running_sum_parity", "changelog_counts", "allowed_lateness",
    "asof_query_filter", "switch_gate", "reconcile_full_outer", "cep_next_next", "cep_within_timeout", "rising_alert",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_equals_sql_when_everything_is_split(spark, folder, db, name):
    spark.conf.set("spark.tidemark.smallInputBytes", "0")
    spark.conf.set("spark.tidemark.chunkRows", "15")
    try:
        assert compare(QUERIES[name](spark, folder), db, ORACLES[name]) == []
    finally:
        spark.conf.unset("spark.tidemark.smallInputBytes")
        spark.conf.unset("spark.tidemark.chunkRows")


STREAMS = ["stream_hot_items_topn", "stream_upsert_last", "stream_cep_within_timeout", "stream_late_side_output"]


@pytest.mark.parametrize("name", STREAMS)
def test_stream_query_equals_sql(spark, folder, db, name):
    assert compare(QUERIES[name](spark, folder), db, ORACLES[name]) == []
