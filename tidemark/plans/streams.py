"""The event table as a stream: Spark's own stateful operators and the custom ones.

Each query drains the stream into a table in the scratch folder and returns that table; its SQL is
the SQL of the batch twin. The streams end with a marker row, see ``events_stream``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.clock import DAY, HOUR, MINUTE
from tidemark.functions.sizing import estimated_bytes
from tidemark.operators import distinct, windows
from tidemark.plans import late as _late, matching, rows  # noqa: F401  (their SQL is reused)
from tidemark.plans.late import ARRIVED, DELAY
from tidemark.plans.registry import ORACLES, query
from tidemark.plans.rolling import ROWS
from tidemark.plans.windows import HOP_COUNT
from tidemark.sinks.versioned import VersionedTable
from tidemark.sinks.writers import batch_files, upsert_table, upserted
from tidemark.session import new_scratch
from tidemark.sources.files import EVENT_TIME, events, events_stream, item
from tidemark.streaming import forms, stateful as st, triggers
from tidemark.streaming.lateness import fired, late_rows, late_windows_writer
from tidemark.streaming.run import drain, drained, start


PARTITION_BYTES = 32 << 20  # of the table in its files


def _partitions(spark, folder) -> int:
    """State partitions: one per core, more only as the table grows, and then no more than the session says. Every
    partition of every store costs a task with its metrics in each micro-batch, however few rows it has."""
    cores = spark.sparkContext.defaultParallelism
    size = estimated_bytes(events(spark, folder)) or 0
    return max(cores, min(-(-size // PARTITION_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _drain(spark, folder, operator: Callable[[DataFrame], DataFrame], marker_type="view", **options) -> DataFrame:
    stream = events_stream(spark, folder, end={"user_id": -1, "event_type": marker_type})
    out = operator(stream.withWatermark("ts", "0 seconds"))
    return drained(out, partitions=_partitions(spark, folder), **options)


def _in_order(spark, folder, automaton: st.Automaton, columns=("event_type",), kinds=None) -> DataFrame:
    """An automaton per user over rows of the given kinds (all kinds when none are given)."""

    def operator(stream: DataFrame) -> DataFrame:
        rows = stream.filter(F.col("event_type").isin(*kinds, "end")) if kinds else stream
        return st.in_order(rows.select("user_id", "ts", "us", *columns), ["user_id"], automaton, slot=MINUTE)

    return _drain(spark, folder, operator, "end").filter(F.col("user_id") >= 0)


@query("stream_tumble_event", ORACLES["tumble_event"])
def stream_tumble_event(spark, folder):
    return _drain(spark, folder, lambda s: windows.tumbling(s, ["event_type"], DAY, [F.count("*").alias("cnt")]))


@query("stream_tumble_manual", ORACLES["tumble_event"])
def stream_tumble_manual(spark, folder):
    """Tumbling windows by hand: counts in map state under salted keys, timers at the ends."""
    stream = events_stream(spark, folder, end={"user_id": -1, "event_type": "view"})
    counts = st.count_windows(stream.select("event_type", "ts", "us").withWatermark("ts", "0 seconds"), ["event_type"], DAY)
    schema = "event_type string, window_start bigint, window_end bigint, cnt bigint"

    def writer(path: str):
        return batch_files(path, lambda parts: st.whole_windows(parts, ["event_type"], DAY))

    return drained(counts, writer, schema=schema, partitions=_partitions(spark, folder)).drop("batch")


@query("stream_hot_items_topn", ORACLES["hot_items_topn"])
def stream_hot_items_topn(spark, folder):
    def operator(s: DataFrame) -> DataFrame:
        views = s.filter(F.col("event_type") == "view").select("ts", "us", item().alias("item"))
        return forms.hot_item_counts(views, "item", DAY, 6 * HOUR)

    schema = "item bigint, window_start bigint, window_end bigint, cnt bigint, rank bigint"
    out = _drain(spark, folder, operator, writer=forms.hot_items_writer(3, "item"), schema=schema)
    return out.drop("batch")


@query("stream_session_count", ORACLES["session_count"])
def stream_session_count(spark, folder):
    return _drain(spark, folder, lambda s: windows.sessions_stream(s, ["user_id"], 12 * HOUR))


@query("stream_uv_exact", ORACLES["uv_exact"])
def stream_uv_exact(spark, folder):
    return _drain(spark, folder, lambda s: distinct.uv_exact(s.filter(F.col("event_type") == "view"), DAY, "user_id"))


@query("stream_group_count", ORACLES["sql_group_count"])
def stream_group_count(spark, folder):
    """Update mode: every changed count per micro-batch, the newest kept per key."""
    clicks = events_stream(spark, folder).select(F.col("user_id").alias("user"))
    schema = "user bigint, cnt bigint"
    counts = forms.group_counts(clicks, ["user"])
    path = drain(counts, lambda out: upsert_table(out, schema, ["user"], "cnt"), "update", partitions=_partitions(spark, folder))
    return VersionedTable(spark, path, ["user"], "cnt", schema).read()


@query("stream_upsert_last", ORACLES["sink_upsert_last"])
def stream_upsert_last(spark, folder):
    clicks = events_stream(spark, folder).selectExpr("user_id AS username", "event_type AS url", "event_id")
    schema = "username bigint, event_id bigint, url string"
    path = drain(clicks, lambda out: upsert_table(out, schema, ["username"], "event_id"))
    return upserted(spark, path, schema, ["username"], "event_id")


def _side(spark, folder, kind: str, prefix: str) -> DataFrame:
    rows = events_stream(spark, folder).filter(F.col("event_type") == kind)
    rows = rows.selectExpr("user_id", f"event_id AS {prefix}_id", f"us AS {prefix}_us", f"ts AS {prefix}_ts")
    return rows.withWatermark(f"{prefix}_ts", "0 seconds")


@query("stream_join_interval", ORACLES["join_interval"])
def stream_join_interval(spark, folder):
    buys, clicks = _side(spark, folder, "purchase", "purchase"), _side(spark, folder, "click", "click")
    out = forms.interval_join(buys, clicks, ["user_id"], "purchase_ts", "click_ts", 24 * HOUR, 6 * HOUR)
    return drained(out.drop("purchase_ts", "click_ts"), partitions=_partitions(spark, folder))


@query("stream_join_window", ORACLES["join_window"])
def stream_join_window(spark, folder):
    buys = _side(spark, folder, "purchase", "purchase").drop("purchase_us")
    clicks = _side(spark, folder, "click", "click").drop("click_us")
    out = forms.window_join(buys, clicks, ["user_id"], "purchase_ts", "click_ts", DAY)
    return drained(out, partitions=_partitions(spark, folder))


@query(
    "stream_running_stats",
    """WITH {E} SELECT u AS user_id, us, count(*) OVER w AS cnt, CAST(sum(id) OVER w AS BIGINT) AS total,
    min(id) OVER w AS low, max(id) OVER w AS high FROM e WINDOW w AS (PARTITION BY u ORDER BY us """ + ROWS + ")",
)
def stream_running_stats(spark, folder):
    """Count, sum, minimum and maximum per user after every single row."""

    def operator(s: DataFrame) -> DataFrame:
        rows = s.select("user_id", "ts", "us", F.coalesce("event_id", F.lit(0)).alias("v"))
        return st.in_order(rows, ["user_id"], st.Stats("v"), slot=MINUTE)

    return _drain(spark, folder, operator).filter(F.col("user_id") >= 0)


@query("stream_fsm_three_fails", ORACLES["fsm_three_fails"])
def stream_fsm_three_fails(spark, folder):
    return _in_order(spark, folder, st.HitRun(lambda r: r.event_type == "error"))


@query("stream_cep_next_next", ORACLES["cep_next_next"])
def stream_cep_next_next(spark, folder):
    found = _in_order(spark, folder, st.Sequence([lambda r: r.event_type == "error"] * 3))
    names = ("first_us", "second_us", "third_us")
    return found.select("user_id", *[F.col("times").getItem(i).alias(n) for i, n in enumerate(names)])


@query("stream_cep_within_timeout", ORACLES["cep_within_timeout"])
def stream_cep_within_timeout(spark, folder):
    stages = [lambda r: r.event_type == "click", lambda r: r.event_type == "purchase"]
    found = _in_order(spark, folder, st.Sequence(stages, 12 * HOUR))
    return found.select("user_id", F.get("times", 0).alias("create_us"), F.get("times", 1).alias("pay_us"), "tag")


@query("stream_order_timeout", ORACLES["order_timeout"])
def stream_order_timeout(spark, folder):
    def is_kind(kind):
        return lambda r: r.event_type == kind

    return _in_order(spark, folder, st.OrderTimeout(is_kind("click"), is_kind("purchase"), 24 * HOUR), kinds=("click", "purchase"))


@query("stream_rising_alert", ORACLES["rising_alert"])
def stream_rising_alert(spark, folder):
    return _in_order(spark, folder, st.RisingAlert("value", 12 * HOUR), columns=("value",))


@query("stream_switch_gate", ORACLES["switch_gate"])
def stream_switch_gate(spark, folder):
    gate = st.Gate(lambda r: r.event_type == "signup", 24 * HOUR)
    return _in_order(spark, folder, gate, ("event_type", "event_id"), ("signup", "view"))


@query("stream_early_fire_counts", ORACLES["early_fire_counts"])
def stream_early_fire_counts(spark, folder):
    return _in_order(spark, folder, st.EarlyFire(DAY, 6 * HOUR))


@query("stream_trigger_early", ORACLES["early_fire_counts"])
def stream_trigger_early(spark, folder):
    """The early firings again, as a trigger on window state."""
    return _in_order(spark, folder, triggers.Triggered(DAY, triggers.Early(6 * HOUR)))


@query(
    "stream_trigger_count_purge",
    """WITH {E}, k AS (SELECT u, us, us // {D} * {D} AS ws, row_number() OVER (PARTITION BY u, us // {D} ORDER BY us) AS n FROM e)
    SELECT u AS user_id, ws AS window_start, us AS fired_at, CAST(3 AS BIGINT) AS cnt FROM k WHERE n % 3 = 0""",
)
def stream_trigger_count_purge(spark, folder):
    """Every third row of a user and day fires the window and empties it."""
    return _in_order(spark, folder, triggers.Triggered(DAY, triggers.EveryN(3)))


@query("stream_reconcile", ORACLES["reconcile_full_outer"])
def stream_reconcile(spark, folder):
    """The n-th click and the n-th purchase of a user, each waiting two days for the other."""
    automaton = st.ReconcileNth(lambda r: r.event_type == "click", 48 * HOUR)
    return _in_order(spark, folder, automaton, kinds=("click", "purchase")).select("user_id", "n", "left_us", "right_us", "outcome")


@query("stream_cep_map_matches", ORACLES["cep_map_matches"])
def stream_cep_map_matches(spark, folder):
    """The pattern of ``cep_map_matches`` on a stream."""

    def operator(stream: DataFrame) -> DataFrame:
        return matching.burst().match_stream(stream, ["user_id"], ["event_id", "us"], slot=MINUTE)

    found = _drain(spark, folder, operator, "end").filter(F.col("user_id") >= 0)
    return matching.burst_rows(found)


@query("stream_event_timers", "WITH {E} SELECT DISTINCT u AS user_id, us + 6*{H} AS timer FROM e")
def stream_event_timers(spark, folder):
    return _in_order(spark, folder, st.ElementTimers(6 * HOUR))


@query("stream_late_side_output", ARRIVED + " SELECT CASE WHEN us < wm THEN 'late' ELSE 'main' END AS output, id AS event_id FROM w")
def stream_late_side_output(spark, folder):
    """Late rows into a second output, record by record in arrival order."""
    late_by = F.pmod(F.col("event_id") * 7919, F.lit(48)) * F.lit(HOUR)
    arrival = f"{EVENT_TIME} + pmod(event_id * 7919, 48) * {HOUR}"
    arrivals = events_stream(spark, folder, order=arrival).select("event_id", (F.col("us") + late_by).alias("arr"), "us")
    path = new_scratch(spark, "routed")
    write = forms.late_router(path, ["arr", "event_id"], DELAY)
    start(arrivals, f"{path}/checkpoint", write=write).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("output", "event_id")


def _late_windows(spark, folder, lateness: int) -> str:
    """Windows of a day over the arrivals in eight micro-batches, then a row far in the future that closes them."""
    late_by = F.pmod(F.col("event_id") * 7919, F.lit(48)) * F.lit(HOUR)
    arrival = f"{EVENT_TIME} + pmod(event_id * 7919, 48) * {HOUR}"
    stream = events_stream(spark, folder, order=arrival, end={"event_id": -1, "event_type": "end"})
    rows = stream.select("event_type", "event_id", "us", (F.col("us") + late_by).alias("arr"))
    keys = {"event_type": "string"}
    return drain(rows, lambda out: late_windows_writer(out, keys, ["arr", "event_id"], DELAY, DAY, lateness))


@query("stream_allowed_lateness", ORACLES["allowed_lateness"])
def stream_allowed_lateness(spark, folder):
    """First firings, one more per row late by up to 12 hours, and the rows too late even for that."""
    path = _late_windows(spark, folder, 12 * HOUR)
    dropped = late_rows(spark, path).groupBy("event_type", "window_end").agg(F.count("*").alias("cnt"))
    dropped = dropped.withColumns({"fire": F.lit(None).cast("bigint"), "kind": F.lit("side_output")})
    return fired(spark, path).unionByName(dropped)


@query("stream_window_late_side_output", ORACLES["window_late_side_output"])
def stream_window_late_side_output(spark, folder):
    """Window counts, and how many rows came after their window had closed."""
    path = _late_windows(spark, folder, 0)
    counted = fired(spark, path).select("event_type", "window_end", "cnt", F.lit(0).alias("late"))
    late = late_rows(spark, path).select("event_type", "window_end", F.lit(0).alias("cnt"), F.lit(1).alias("late"))
    both = counted.unionByName(late).groupBy("event_type", "window_end")
    return both.agg(F.sum("cnt").alias("cnt"), F.sum("late").alias("late"))


@query("stream_sql_hop_count", ORACLES["sql_hop_count"])
def stream_sql_hop_count(spark, folder):
    """The SQL statement of the batch form on a streaming view."""

    def operator(s: DataFrame) -> DataFrame:
        views = s.filter(F.col("event_type") == "view").select("ts", item().alias("item"))
        views.createOrReplaceTempView("tidemark_views")
        return spark.sql(HOP_COUNT)

    return _drain(spark, folder, operator)


@query("stream_changelog_counts", ORACLES["changelog_counts"])
def stream_changelog_counts(spark, folder):
    """Row kinds of a count per user, record by record."""
    return _in_order(spark, folder, st.CountChanges("event_id"), ("event_id",))


@query("stream_asof_query_filter", ORACLES["asof_query_filter"])
def stream_asof_query_filter(spark, folder):
    """Signups as control stream, everything else as data, in one stream."""
    k = item()
    wanted = F.when(k < 25, "view").when(k < 50, "click").when(k < 75, "purchase").otherwise("error")
    is_control = F.col("event_type") == "signup"
    rows = events_stream(spark, folder).select("event_id", "us", "event_type", F.when(is_control, wanted).alias("wanted"))
    path = new_scratch(spark, "control")
    write = forms.control_filter(path, is_control, "us", "wanted", F.col("event_type") == F.col("wanted"))
    start(rows, f"{path}/checkpoint", write=write).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_id", "event_type")
