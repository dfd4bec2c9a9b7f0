"""Windows, distinct counts, top-N, and the SQL forms of the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.clock import DAY, HOUR
from tidemark.operators import distinct, topn, window_functions, windows
from tidemark.plans.registry import query
from tidemark.sources.files import events, item, table


def _views(spark, folder):
    views = events(spark, folder).filter(F.col("event_type") == "view")
    return views.select("user_id", item().alias("item"), "ts", "us")


@query(
    "tumble_full",
    """WITH {E} SELECT t AS event_type, us // {D} * {D} AS window_start, us // {D} * {D} + {D} AS window_end,
    count(*) AS cnt, min(us) AS first_us, max(us) AS last_us, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM e GROUP BY 1, 2, 3""",
)
def tumble_full(spark, folder):
    aggs = [
        F.count("*").alias("cnt"),
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    ]
    return windows.tumbling(events(spark, folder), ["event_type"], DAY, aggs)


class TwoGreatest(window_functions.Accumulator):
    """Number of values, and the two greatest of them."""

    sql_type = "array<double>"

    def create(self):
        return []

    def add(self, acc, elements):
        values = elements["value"].dropna()
        return self.merge(acc, [float(len(values)), *values.nlargest(2)])

    def merge(self, a, b):
        if not len(a) or not len(b):
            return list(a if len(a) else b)
        return [a[0] + b[0], *sorted([*a[1:], *b[1:]], reverse=True)[:2]]


@query(
    "tumble_user_function",
    """WITH {E} SELECT t AS event_type, us // {D} * {D} AS window_start, us // {D} * {D} + {D} AS window_end, count(v) AS cnt,
    max(v) AS greatest, list_sort(list(v), 'DESC', 'NULLS LAST')[2] AS second FROM e WHERE v IS NOT NULL GROUP BY 1, 2, 3""",
)
def tumble_user_function(spark, folder):
    """A user accumulator per key and window, and a function that adds the bounds."""

    def finish(key, start, end, acc):
        return [(int(acc[0]), acc[1], acc[2] if len(acc) > 2 else None)]

    rows = events(spark, folder).filter("value IS NOT NULL")
    output = "cnt bigint, greatest double, second double"
    return window_functions.aggregate_window(rows, ["event_type"], DAY, ["value"], TwoGreatest(), finish, output)


@query(
    "tumble_process_function",
    """WITH {E}, a AS (SELECT *, us // {D} * {D} AS ws FROM e WHERE v IS NOT NULL), d AS (SELECT *, CASE WHEN v < lag(v) OVER o
    THEN 1 ELSE 0 END AS fell FROM a WINDOW o AS (PARTITION BY t, ws ORDER BY us, id)), r AS (SELECT *, sum(fell) OVER (PARTITION
    BY t, ws ORDER BY us, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM d), n AS (SELECT t, ws, run, count(*)
    AS k FROM r GROUP BY ALL) SELECT t AS event_type, ws AS window_start, ws + {D} AS window_end, CAST(sum(k) AS BIGINT) AS cnt,
    max(k) AS longest_rise FROM n GROUP BY ALL""",
)
def tumble_process_function(spark, folder):
    """A function over all elements of a window in order: the longest run of values that do not fall."""

    def longest(key, start, end, elements):
        n, run, best, last = 0, 0, 0, None
        for batch in elements:
            for v in batch["value"]:
                run = run + 1 if last is None or v >= last else 1
                n, best, last = n + 1, max(best, run), v
        return [(n, best)]

    rows = events(spark, folder).filter("value IS NOT NULL")
    output = "cnt bigint, longest_rise bigint"
    return window_functions.process_window(rows, ["event_type"], DAY, ["value"], longest, output, order=["us", "event_id"])


@query("tumble_incremental", "WITH {E} SELECT t AS event_type, count(*) AS cnt FROM e GROUP BY t, us // {D}")
def tumble_incremental(spark, folder):
    counts = windows.tumbling(events(spark, folder), ["event_type"], DAY, [F.count("*").alias("cnt")])
    return counts.select("event_type", "cnt")


TUMBLE_SQL = """WITH {E} SELECT t AS event_type, us // {D} * {D} AS window_start, us // {D} * {D} + {D} AS window_end,
  count(*) AS cnt FROM e GROUP BY 1, 2, 3"""


@query("tumble_incremental_bounds", TUMBLE_SQL)
def tumble_incremental_bounds(spark, folder):
    return windows.tumbling(events(spark, folder), ["event_type"], DAY, [F.count("*").alias("cnt")])


@query("tumble_event", TUMBLE_SQL)
def tumble_event(spark, folder):
    """The batch answer of the event-time window; the watermark matters only on a stream."""
    marked = events(spark, folder).withWatermark("ts", "5 seconds")
    return windows.tumbling(marked, ["event_type"], DAY, [F.count("*").alias("cnt")])


@query("tumble_manual", TUMBLE_SQL)
def tumble_manual(spark, folder):
    return windows.tumbling_by_hand(events(spark, folder), ["event_type"], DAY)


@query(
    "tumble_global",
    "WITH {E} SELECT us // {D} * {D} AS window_start, us // {D} * {D} + {D} AS window_end, count(*) AS cnt FROM e GROUP BY 1, 2",
)
def tumble_global(spark, folder):
    return windows.tumbling(events(spark, folder), [], DAY, [F.count("*").alias("cnt")])


HOP_SQL = """WITH {E}, x AS (SELECT k AS item, us // (6*{H}) * 6*{H} - i*6*{H} AS window_start
  FROM e, range(4) AS g(i) WHERE t = 'view'), c AS (SELECT item, window_start, window_start + {D} AS window_end,
  count(*) AS cnt FROM x GROUP BY item, window_start)"""


@query("slide_count", HOP_SQL + " SELECT * FROM c")
def slide_count(spark, folder):
    return windows.sliding_counts(_views(spark, folder), ["item"], DAY, 6 * HOUR)


TOP3_SQL = HOP_SQL + """, r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, item) AS rank
  FROM c) SELECT * FROM r WHERE rank <= 3"""


@query("hot_items_topn", TOP3_SQL)
def hot_items_topn(spark, folder):
    """Three most viewed items of every 24-hour window that starts every 6 hours."""
    return topn.hot_items(_views(spark, folder), "item", DAY, 6 * HOUR, 3)


@query(
    "top1_per_window",
    """WITH {E}, c AS (SELECT us // {D} * {D} AS window_start, t AS event_type, count(*) AS cnt FROM e GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, event_type) AS n FROM c)
    SELECT window_start, window_start + {D} AS window_end, event_type, cnt FROM r WHERE n = 1""",
)
def top1_per_window(spark, folder):
    counts = windows.tumbling(events(spark, folder), ["event_type"], DAY, [F.count("*").alias("cnt")])
    return topn.top1(counts, ["window_start", "window_end"], "event_type", "cnt")


@query(
    "session_count",
    """WITH {E}, g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY u ORDER BY us) <= 12*{H} THEN 0 ELSE 1 END AS st
    FROM e), s AS (SELECT *, sum(st) OVER (PARTITION BY u ORDER BY us) AS sid FROM g) SELECT u AS user_id,
    min(us) AS window_start, max(us) + 12*{H} AS window_end, count(*) AS cnt FROM s GROUP BY u, sid""",
)
def session_count(spark, folder):
    return windows.sessions(events(spark, folder), ["user_id"], 12 * HOUR)


@query(
    "early_fire_counts",
    """WITH {E}, k1 AS (SELECT *, us // {D} * {D} AS ws FROM e), f AS (SELECT u, ws, (min(us) // (6*{H}) + 1) * 6*{H} AS t0,
    count(*) AS n FROM k1 GROUP BY u, ws), tk AS (SELECT u, ws, unnest(range(t0, ws + {D}, 6*{H})) AS tick FROM f)
    SELECT tk.u AS user_id, tk.ws AS window_start, tick AS fired_at, count(k1.us) AS cnt FROM tk JOIN k1 ON k1.u = tk.u
    AND k1.ws = tk.ws AND k1.us <= tick GROUP BY ALL UNION ALL SELECT u, ws, ws + {D} - 1, n FROM f""",
)
def early_fire_counts(spark, folder):
    return windows.early_fires(events(spark, folder), ["user_id"], DAY, 6 * HOUR)


UV_SQL = """WITH {E} SELECT us // {D} * {D} AS window_start, us // {D} * {D} + {D} AS window_end,
  count(DISTINCT u) AS uv%s FROM e WHERE t = 'view' GROUP BY 1, 2"""


@query("uv_exact", UV_SQL % "")
def uv_exact(spark, folder):
    return distinct.uv_exact(_views(spark, folder), DAY, "user_id")


@query("uv_approx", UV_SQL % ", true AS within_5pct")
def uv_approx(spark, folder):
    return distinct.uv_sketch_checked(_views(spark, folder), DAY, "user_id")


@query("uv_bloom", UV_SQL % ", true AS never_over, true AS within_error")
def uv_bloom(spark, folder):
    """Visitors per day from bit sets, next to the exact number."""
    df = _views(spark, folder)
    start = F.window("ts", "1 day")["start"]
    keys = [F.unix_micros(start), F.unix_micros(start) + F.lit(DAY)]
    return distinct.uv_bloom_checked(df, keys, ["window_start", "window_end"], "user_id")


@query(
    "bloom_distinct_lines",
    """SELECT l_linestatus AS status, count(DISTINCT l_orderkey * 8 + l_linenumber) AS uv, true AS never_over, true AS within_error
    FROM lineitem GROUP BY 1""",
)
def bloom_distinct_lines(spark, folder):
    """Many ids per key: the lines of an order status, in a bit set for 400,000."""
    lines = table(spark, folder, "lineitem").select("l_linestatus", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"))
    return distinct.uv_bloom_checked(lines, [F.col("l_linestatus")], ["status"], "line", expected=400_000)


@query(
    "sql_rename_view",
    'WITH {E} SELECT u AS "user", t AS url, us AS "cTime" FROM e',
)
def sql_rename_view(spark, folder):
    clicks = events(spark, folder).select("user_id", "event_type", "us").toDF("user", "url", "cTime")
    clicks.createOrReplaceTempView("tidemark_renamed")
    return spark.sql("SELECT user, url, cTime FROM tidemark_renamed")


@query("sql_group_count", 'SELECT user_id AS "user", count(event_type) AS cnt FROM events GROUP BY user_id')
def sql_group_count(spark, folder):
    clicks = events(spark, folder).select("user_id", "event_type").toDF("user", "url")
    clicks.createOrReplaceTempView("tidemark_clicks")
    return spark.sql("SELECT user, count(url) AS cnt FROM tidemark_clicks GROUP BY user")


HOP_COUNT = """
  SELECT item, unix_micros(window.start) AS window_start, unix_micros(window.end) AS window_end, count(*) AS cnt
  FROM tidemark_views GROUP BY item, window(ts, '24 hours', '6 hours')"""


@query("sql_hop_count", HOP_SQL + " SELECT * FROM c")
def sql_hop_count(spark, folder):
    _views(spark, folder).createOrReplaceTempView("tidemark_views")
    return spark.sql(HOP_COUNT)


@query("sql_hop_topn", TOP3_SQL)
def sql_hop_topn(spark, folder):
    _views(spark, folder).createOrReplaceTempView("tidemark_views")
    return spark.sql(
        f"""SELECT item, window_start, window_end, cnt, CAST(row_num AS BIGINT) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item) AS row_num FROM ({HOP_COUNT}))
        WHERE row_num <= 3"""
    )
