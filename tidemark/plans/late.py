"""Watermarks, lateness, timers, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.clock import DAY, HOUR
from tidemark.operators import watermarks as wm
from tidemark.plans.registry import query
from tidemark.sources.files import events

ARRIVAL = ["arr", "event_id"]
DELAY = 12 * HOUR


def arrivals(spark, folder):
    """Events in a shuffled but repeatable arrival order: up to two days late."""
    late_by = F.pmod(F.col("event_id") * 7919, F.lit(48)) * F.lit(HOUR)
    return events(spark, folder).withColumn("arr", F.col("us") + late_by).select("event_id", "arr", "us", "event_type")


ARRIVED = """WITH {E}, a AS (SELECT *, us + (id * 7919 % 48) * {H} AS arr FROM e), w AS (SELECT *, max(us) OVER (ORDER BY
  arr, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 12*{H} - 1 AS wm, us // {D} * {D} + {D} AS wend FROM a)"""


@query(
    "watermark_trace",
    ARRIVED + " SELECT id AS event_id, wm AS wm_before, greatest(coalesce(wm, us - 12*{H} - 1), us - 12*{H} - 1) AS wm_after FROM w",
)
def watermark_trace(spark, folder):
    trace = wm.watermark_trace(arrivals(spark, folder), ARRIVAL, DELAY)
    return trace.select("event_id", "wm_before", "wm_after")


@query(
    "watermark_punctuated",
    ARRIVED + """ SELECT id AS event_id, max(CASE WHEN t = 'signup' THEN us - 1 END) OVER (ORDER BY arr, id ROWS BETWEEN
    UNBOUNDED PRECEDING AND CURRENT ROW) AS wm_after FROM w""",
)
def watermark_punctuated(spark, folder):
    trace = wm.punctuated_trace(arrivals(spark, folder), ARRIVAL, F.col("event_type") == "signup")
    return trace.select("event_id", "wm_after")


@query(
    "event_timers",
    """WITH {E} SELECT DISTINCT u AS user_id, us + 6*{H} AS timer, us + 6*{H} <= (SELECT max(us) - 1 FROM e) AS fired
    FROM e""",
)
def event_timers(spark, folder):
    return wm.element_timers(events(spark, folder), ["user_id"], 6 * HOUR)


@query("late_flag", ARRIVED + " SELECT id AS event_id, coalesce(us < wm, false) AS late FROM w")
def late_flag(spark, folder):
    seen = wm.with_watermark_before(arrivals(spark, folder), ARRIVAL, DELAY)
    return seen.select("event_id", wm.late().alias("late"))


@query(
    "late_side_output",
    ARRIVED + " SELECT CASE WHEN us < wm THEN 'late' ELSE 'main' END AS output, id AS event_id, t AS event_type FROM w",
)
def late_side_output(spark, folder):
    seen = wm.with_watermark_before(arrivals(spark, folder), ARRIVAL, DELAY)
    return seen.select(F.when(wm.late(), "late").otherwise("main").alias("output"), "event_id", "event_type")


@query(
    "window_late_side_output",
    ARRIVED + """ SELECT t AS event_type, wend AS window_end, count(*) FILTER (WHERE wm IS NULL OR wend - 1 > wm) AS cnt,
    count(*) FILTER (WHERE wend - 1 <= wm) AS late FROM w GROUP BY 1, 2""",
)
def window_late_side_output(spark, folder):
    return wm.window_late_counts(arrivals(spark, folder), ["event_type"], ARRIVAL, DELAY, DAY)


@query(
    "allowed_lateness",
    ARRIVED + """, s AS (SELECT *, CASE WHEN wm IS NULL OR wend - 1 > wm THEN 'on_time' WHEN wend - 1 + 12*{H} > wm THEN
    'accepted' ELSE 'dropped' END AS st FROM w), o AS (SELECT t, wend, count(*) AS n0 FROM s WHERE st = 'on_time' GROUP BY
    ALL), x AS (SELECT s.t, s.wend, row_number() OVER (PARTITION BY s.t, s.wend ORDER BY arr, id) AS rk FROM s WHERE
    st = 'accepted') SELECT t AS event_type, wend AS window_end, CAST(0 AS BIGINT) AS fire, n0 AS cnt, 'first' AS kind FROM o
    UNION ALL SELECT x.t, x.wend, rk, coalesce(n0, 0) + rk, CASE WHEN n0 IS NULL AND rk = 1 THEN 'first' ELSE 'refire' END
    FROM x LEFT JOIN o ON o.t = x.t AND o.wend = x.wend UNION ALL SELECT t, wend, NULL, count(*), 'side_output' FROM s
    WHERE st = 'dropped' GROUP BY t, wend""",
)
def allowed_lateness(spark, folder):
    return wm.allowed_lateness(arrivals(spark, folder), ["event_type"], ARRIVAL, DELAY, DAY, 12 * HOUR)


@query(
    "union_streams",
    """SELECT 'left' AS side, event_id, user_id FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'right', event_id, user_id FROM events WHERE event_type = 'purchase'""",
)
def union_streams(spark, folder):
    both = events(spark, folder)
    clicks = both.filter(F.col("event_type") == "click").select(F.lit("left").alias("side"), "event_id", "user_id")
    buys = both.filter(F.col("event_type") == "purchase").select(F.lit("right").alias("side"), "event_id", "user_id")
    return clicks.unionByName(buys)


@query(
    "union_min_watermark",
    """WITH {E}, m AS (SELECT id, max(CASE WHEN t = 'click' THEN us END) OVER w AS lm, max(CASE WHEN t = 'purchase' THEN us
    END) OVER w AS rm FROM e WHERE t IN ('click', 'purchase') WINDOW w AS (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND
    CURRENT ROW)) SELECT id AS event_id, CASE WHEN lm IS NOT NULL AND rm IS NOT NULL THEN least(lm, rm) - 1 END AS wm_after
    FROM m""",
)
def union_min_watermark(spark, folder):
    both = events(spark, folder).filter(F.col("event_type").isin("click", "purchase"))
    rows = both.select("event_id", "us", (F.col("event_type") == "click").alias("is_left"))
    return wm.min_watermark_trace(rows, ["event_id"], F.col("is_left")).select("event_id", "wm_after")
