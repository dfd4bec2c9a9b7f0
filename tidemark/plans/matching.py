"""Joins of several inputs, and event patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.clock import DAY, HOUR
from tidemark.operators import joins, patterns
from tidemark.operators.pattern import Pattern, select_each
from tidemark.plans.registry import query
from tidemark.sources.files import events, item, table


def _of(spark, folder, kind, *columns):
    return events(spark, folder).filter(F.col("event_type") == kind).select(*columns)


@query(
    "join_inner",
    """SELECT o_orderkey AS orderkey, l_linenumber AS linenumber, o_custkey AS custkey, l_quantity AS quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_inner(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"))
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_quantity").alias("quantity")
    )
    return joins.inner_join(orders, items, ["orderkey"])


@query(
    "join_inner_counts",
    "SELECT o_orderkey AS orderkey, count(*) AS pairs FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1",
)
def join_inner_counts(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"))
    items = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return joins.matches_per_key(orders, items, "orderkey")


@query(
    "join_interval",
    """WITH {E} SELECT a.u AS user_id, a.id AS purchase_id, a.us AS purchase_us, b.id AS click_id, b.us AS click_us
    FROM e a JOIN e b ON a.u = b.u AND a.t = 'purchase' AND b.t = 'click' AND b.us BETWEEN a.us - 24*{H} AND a.us + 6*{H}""",
)
def join_interval(spark, folder):
    buys = _of(spark, folder, "purchase", "user_id", F.col("event_id").alias("purchase_id"), F.col("us").alias("purchase_us"))
    clicks = _of(spark, folder, "click", "user_id", F.col("event_id").alias("click_id"), F.col("us").alias("click_us"))
    return joins.interval_join(buys, clicks, ["user_id"], "purchase_us", "click_us", 24 * HOUR, 6 * HOUR)


@query(
    "join_window",
    """WITH {E} SELECT a.u AS user_id, a.us // {D} * {D} AS window_start, a.id AS purchase_id, b.id AS click_id FROM e a
    JOIN e b ON a.u = b.u AND a.t = 'purchase' AND b.t = 'click' AND a.us // {D} = b.us // {D}""",
)
def join_window(spark, folder):
    buys = _of(spark, folder, "purchase", "user_id", F.col("event_id").alias("purchase_id"), F.col("us").alias("purchase_us"))
    clicks = _of(spark, folder, "click", "user_id", F.col("event_id").alias("click_id"), F.col("us").alias("click_us"))
    pairs = joins.window_join(buys, clicks, ["user_id"], "purchase_us", "click_us", DAY)
    return pairs.select("user_id", "window_start", "purchase_id", "click_id")


@query(
    "asof_query_filter",
    """WITH {E}, q AS (SELECT us, CASE WHEN k < 25 THEN 'view' WHEN k < 50 THEN 'click' WHEN k < 75 THEN 'purchase'
    ELSE 'error' END AS wanted, coalesce(lead(us) OVER (ORDER BY us), 9223372036854775807) AS nxt FROM e WHERE t = 'signup')
    SELECT e.id AS event_id, e.t AS event_type FROM e JOIN q ON e.t = q.wanted AND e.us >= q.us AND e.us < q.nxt""",
)
def asof_query_filter(spark, folder):
    """Each signup names the event type to let through until the next signup."""
    rows = events(spark, folder).select("event_id", "us", "event_type", item().alias("k"))
    k = F.col("k")
    wanted = F.when(k < 25, "view").when(k < 50, "click").when(k < 75, "purchase").otherwise("error")
    control = rows.filter(F.col("event_type") == "signup").select("us", wanted.alias("wanted"))
    data = rows.filter(F.col("event_type") != "signup").select("event_id", "us", "event_type")
    held = joins.latest_control(data, control, [], "us", "wanted")
    return held.filter(F.col("event_type") == F.col("wanted")).select("event_id", "event_type")


@query(
    "switch_gate",
    """WITH {E}, m AS (SELECT u, us, 0 AS prio, true AS flag, NULL::BIGINT AS id FROM e WHERE t = 'signup' UNION ALL SELECT u,
    us + 24*{H}, 1, false, NULL FROM e WHERE t = 'signup' UNION ALL SELECT u, us, 2, NULL, id FROM e WHERE t = 'view'),
    w AS (SELECT *, last_value(flag IGNORE NULLS) OVER (PARTITION BY u ORDER BY us, prio ROWS BETWEEN UNBOUNDED PRECEDING AND
    CURRENT ROW) AS is_open FROM m) SELECT id AS event_id, u AS user_id, us FROM w WHERE id IS NOT NULL AND is_open""",
)
def switch_gate(spark, folder):
    views = _of(spark, folder, "view", "user_id", "event_id", "us")
    signups = _of(spark, folder, "signup", "user_id", "us")
    return joins.gate(views, signups, ["user_id"], "us", 24 * HOUR).select("event_id", "user_id", "us")


@query(
    "reconcile_full_outer",
    """WITH {E}, l AS (SELECT u, row_number() OVER (PARTITION BY u ORDER BY us) AS n, us FROM e WHERE t = 'click'),
    r AS (SELECT u, row_number() OVER (PARTITION BY u ORDER BY us) AS n, us FROM e WHERE t = 'purchase') SELECT
    coalesce(l.u, r.u) AS user_id, coalesce(l.n, r.n) AS n, l.us AS left_us, r.us AS right_us, CASE WHEN l.us IS NULL THEN
    'right_only' WHEN r.us IS NULL THEN 'left_only' WHEN l.us <= r.us THEN 'left_first' ELSE 'right_first' END AS outcome
    FROM l FULL OUTER JOIN r ON l.u = r.u AND l.n = r.n AND abs(l.us - r.us) <= 48*{H}""",
)
def reconcile_full_outer(spark, folder):
    left = joins.number_per_key(_of(spark, folder, "click", "user_id", F.col("us").alias("left_us")), ["user_id"], ["left_us"])
    right = joins.number_per_key(
        _of(spark, folder, "purchase", "user_id", F.col("us").alias("right_us")), ["user_id"], ["right_us"]
    )
    return joins.reconcile(left, right, ["user_id", "n"], "left_us", "right_us", 48 * HOUR)


LEADS = """WITH {E}, w AS (SELECT *, lead(t) OVER p AS t2, lead(t, 2) OVER p AS t3, lead(us) OVER p AS us2,
  lead(us, 2) OVER p AS us3 FROM e WINDOW p AS (PARTITION BY u ORDER BY us))"""
FAILS = " FROM w WHERE t = 'error' AND t2 = 'error' AND t3 = 'error'"


def _history(spark, folder):
    return events(spark, folder).select("user_id", "us", "event_type")


@query("fsm_three_fails", LEADS + " SELECT u AS user_id, us3 AS us" + FAILS)
def fsm_three_fails(spark, folder):
    hits = patterns.repeats(_history(spark, folder), ["user_id"], ["us"], F.col("event_type") == "error", 3)
    return hits.select("user_id", "us")


def burst():
    """Two errors in a row, then something else, within two days."""
    error = F.col("event_type") == "error"
    return Pattern.begin("errors", error).times(2).next("after", ~error).within(48 * HOUR)


def burst_rows(found):
    """Every row of every match, with its stage and place there."""
    rows = F.flatten(
        F.transform(
            F.map_entries("match"),
            lambda e: F.transform(e["value"], lambda r, i: F.struct(e["key"].alias("stage"), i.alias("place"), r["event_id"].alias("event_id"), r["us"].alias("us"))),
        )
    )
    first = F.col("match")["errors"][0]["us"].alias("begun_us")
    each = select_each(found.select("user_id", first, "tag", rows.alias("rows")), F.col("rows"), ["user_id", "begun_us", "tag"])
    return each.withColumn("place", F.col("place").cast("int"))


@query(
    "cep_map_matches",
    """WITH {E}, w AS (SELECT *, lead(t) OVER p AS t2, lead(t, 2) OVER p AS t3, lead(us) OVER p AS us2, lead(us, 2) OVER p AS us3,
    lead(id) OVER p AS id2, lead(id, 2) OVER p AS id3 FROM e WINDOW p AS (PARTITION BY u ORDER BY us)), s AS (SELECT *,
    coalesce(us2 - us < 48*{H}, false) AS in2, coalesce(us3 - us < 48*{H}, false) AS in3 FROM w WHERE t = 'error'),
    m AS (SELECT *, CASE WHEN NOT in2 THEN 1 WHEN t2 = 'error' AND NOT in3 THEN 2 WHEN t2 = 'error' AND t3 <> 'error' THEN 3 END AS reached FROM s)
    SELECT u AS user_id, m.us AS begun_us, CASE WHEN reached = 3 THEN 'match' ELSE 'timeout' END AS tag, x.stage, CAST(x.place AS INTEGER) AS place,
    x.id AS event_id, x.us AS us FROM m, LATERAL (SELECT * FROM (VALUES (1, 'errors', 0, m.id, m.us), (2, 'errors', 1, m.id2, m.us2),
    (3, 'after', 0, m.id3, m.us3)) v(i, stage, place, id, us) WHERE i <= m.reached) x WHERE reached IS NOT NULL""",
)
def cep_map_matches(spark, folder):
    """Matches as maps from stage to rows, then one row per row of a match."""
    history = events(spark, folder).select("user_id", "us", "event_type", "event_id")
    return burst_rows(burst().match(history, ["user_id"], ["us"], ["event_id", "us"]))


def _fail(row):
    return row("event_type") == "error"


@query("cep_next_next", LEADS + " SELECT u AS user_id, us AS first_us, us2 AS second_us, us3 AS third_us" + FAILS)
def cep_next_next(spark, folder):
    stages = [("first", _fail), ("second", _fail), ("third", _fail)]
    return patterns.match_recognize(_history(spark, folder), ["user_id"], ["us"], stages, ["us"]).drop("tag")


@query("cep_times_consecutive", LEADS + " SELECT u AS user_id, us AS us_1, us2 AS us_2, us3 AS us_3, CAST(3 AS INTEGER) AS n" + FAILS)
def cep_times_consecutive(spark, folder):
    hits = patterns.repeats(_history(spark, folder), ["user_id"], ["us"], F.col("event_type") == "error", 3)
    each = [F.col("times").getItem(i).alias(f"us_{i + 1}") for i in range(3)]
    return hits.select("user_id", *each, F.size("times").alias("n"))


@query(
    "cep_within_timeout",
    LEADS + """ SELECT u AS user_id, us AS create_us, CASE WHEN us2 - us < 12*{H} AND t2 = 'purchase' THEN us2 END AS pay_us,
    CASE WHEN us2 - us < 12*{H} AND t2 = 'purchase' THEN 'match' ELSE 'timeout' END AS tag FROM w
    WHERE t = 'click' AND (us2 IS NULL OR us2 - us >= 12*{H} OR t2 = 'purchase')""",
)
def cep_within_timeout(spark, folder):
    stages = [
        ("create", lambda row: row("event_type") == "click"),
        ("pay", lambda row: row("event_type") == "purchase"),
    ]
    return patterns.match_recognize(_history(spark, folder), ["user_id"], ["us"], stages, ["us"], within=12 * HOUR)


@query(
    "order_timeout",
    """WITH {E}, r AS (SELECT u, us, t FROM e WHERE t IN ('click', 'purchase')), f AS (SELECT u, min(us) AS us0,
    arg_min(t, us) AS t0 FROM r GROUP BY u) SELECT u AS user_id, us, 'paid' AS tag FROM r WHERE t = 'purchase' UNION ALL
    SELECT u, us0 + 24*{H}, 'timeout' FROM f WHERE t0 = 'click' AND NOT EXISTS (SELECT 1 FROM r WHERE r.u = f.u AND
    r.t = 'purchase' AND r.us <= f.us0 + 24*{H})""",
)
def order_timeout(spark, folder):
    kind = F.col("event_type")
    return patterns.order_timeouts(_history(spark, folder), ["user_id"], kind == "click", kind == "purchase", 24 * HOUR)


@query(
    "rising_alert",
    """WITH RECURSIVE {E}, p AS (SELECT *, lag(v) OVER (PARTITION BY u ORDER BY us) AS pv FROM e), s AS (SELECT *, sum(CASE
    WHEN v < pv THEN 1 ELSE 0 END) OVER (PARTITION BY u ORDER BY us) AS seg FROM p), rise AS (SELECT u, seg, us FROM s WHERE
    v > pv), fall AS (SELECT u, seg, us FROM s WHERE v < pv), r(u, seg, st) AS (SELECT u, seg, min(us) FROM rise GROUP BY ALL
    UNION ALL SELECT r.u, r.seg, (SELECT min(us) FROM rise x WHERE x.u = r.u AND x.seg = r.seg AND x.us > r.st + 12*{H})
    FROM r WHERE EXISTS (SELECT 1 FROM rise x WHERE x.u = r.u AND x.seg = r.seg AND x.us > r.st + 12*{H})) SELECT
    r.u AS user_id, r.st + 12*{H} AS alert_us FROM r LEFT JOIN fall f ON f.u = r.u AND f.seg = r.seg + 1
    WHERE f.us IS NULL OR f.us > r.st + 12*{H}""",
)
def rising_alert(spark, folder):
    readings = events(spark, folder).select("user_id", "us", "value")
    return patterns.rising_alerts(readings, ["user_id"], ["us"], "value", 12 * HOUR)
