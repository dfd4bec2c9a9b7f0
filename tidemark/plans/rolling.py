"""Rolling aggregates: one output per input row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.clock import idiv
from tidemark.operators import rows
from tidemark.operators.changelog import count_changes, replay
from tidemark.operators.ordered import running
from tidemark.plans.registry import query
from tidemark.plans.rows import TOKENS_SQL, texts
from tidemark.sources.files import events, item

ROWS = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _items(spark, folder):
    return events(spark, folder).select("event_id", "user_id", item().alias("k"))


@query(
    "running_word_count",
    "WITH " + TOKENS_SQL + " SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos " + ROWS + ") AS cnt FROM tok",
)
def running_word_count(spark, folder):
    words = rows.tokenize(texts(spark, folder))
    return running(words, ["word"], ["doc_id", "pos"], {"cnt": ("count", F.lit(1))})


@query(
    "running_line_count",
    """WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), l AS (SELECT doc_id,
    CAST(unnest(range(len(ls))) AS INTEGER) AS pos, unnest(ls) AS line FROM s) SELECT doc_id, pos, line,
    count(*) OVER (PARTITION BY line ORDER BY doc_id, pos """ + ROWS + ") AS cnt FROM l",
)
def running_line_count(spark, folder):
    lines = rows.lines(texts(spark, folder))
    return running(lines, ["line"], ["doc_id", "pos"], {"cnt": ("count", F.lit(1))})


@query(
    "running_sum_parity",
    "WITH {E} SELECT id AS event_id, id % 2 AS parity, CAST(sum(k) OVER (PARTITION BY id % 2 ORDER BY id " + ROWS + ") AS BIGINT) AS total FROM e",
)
def running_sum_parity(spark, folder):
    data = _items(spark, folder).withColumn("parity", F.pmod("event_id", F.lit(2)))
    out = running(data, ["parity"], ["event_id"], {"total": ("sum", F.col("k"))})
    return out.select("event_id", "parity", "total")


@query(
    "running_sum_all",
    "WITH {E} SELECT id AS event_id, CAST(sum(k) OVER (ORDER BY id " + ROWS + ") AS BIGINT) AS total FROM e",
)
def running_sum_all(spark, folder):
    out = running(_items(spark, folder), [], ["event_id"], {"total": ("sum", F.col("k"))})
    return out.select("event_id", "total")


@query(
    "running_min_max",
    "WITH {E} SELECT id AS event_id, min(k) OVER w AS low, max(k) OVER w AS high FROM e WINDOW w AS (ORDER BY id " + ROWS + ")",
)
def running_min_max(spark, folder):
    aggs = {"low": ("min", F.col("k")), "high": ("max", F.col("k"))}
    return running(_items(spark, folder), [], ["event_id"], aggs).select("event_id", "low", "high")


@query(
    "running_avg_int",
    "WITH {E} SELECT id AS event_id, CAST(sum(k) OVER w AS BIGINT) // count(*) OVER w AS average FROM e WINDOW w AS (ORDER BY id " + ROWS + ")",
)
def running_avg_int(spark, folder):
    aggs = {"s": ("sum", F.col("k")), "n": ("count", F.lit(1))}
    out = running(_items(spark, folder), [], ["event_id"], aggs)
    return out.select("event_id", idiv(F.col("s"), F.col("n")).alias("average"))


@query(
    "running_pv_user",
    "WITH {E} SELECT id AS event_id, u AS user_id, count(*) OVER (PARTITION BY u ORDER BY id " + ROWS + ") AS pv FROM e",
)
def running_pv_user(spark, folder):
    data = events(spark, folder).select("event_id", "user_id")
    return running(data, ["user_id"], ["event_id"], {"pv": ("count", F.lit(1))})


@query(
    "state_min_max_avg",
    """WITH {E} SELECT id AS event_id, u AS user_id, min(k) OVER w AS low, max(k) OVER w AS high,
    CAST(sum(k) OVER w AS BIGINT) // count(*) OVER w AS average FROM e
    WINDOW w AS (PARTITION BY u ORDER BY id """ + ROWS + ")",
)
def state_min_max_avg(spark, folder):
    k = F.col("k")
    aggs = {"low": ("min", k), "high": ("max", k), "s": ("sum", k), "n": ("count", F.lit(1))}
    out = running(_items(spark, folder), ["user_id"], ["event_id"], aggs)
    return out.select("event_id", "user_id", "low", "high", idiv(F.col("s"), F.col("n")).alias("average"))


@query(
    "running_value_sum",
    """WITH {E} SELECT id AS event_id, CAST(sum(CAST(v AS DECIMAL(18,2))) OVER (PARTITION BY u ORDER BY id """ + ROWS + """)
    AS DOUBLE) AS total FROM e""",
)
def running_value_sum(spark, folder):
    """Money-like doubles are summed as decimals, so the answer does not depend on the order of adding."""
    data = events(spark, folder).select("event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("v"))
    out = running(data, ["user_id"], ["event_id"], {"total": ("sum", F.col("v"))})
    return out.select("event_id", F.col("total").cast("double").alias("total"))


COUNTED_SQL = "WITH {E}, c AS (SELECT u, id, count(*) OVER (PARTITION BY u ORDER BY id " + ROWS + ") AS n FROM e)"


@query(
    "changelog_counts",
    COUNTED_SQL + """ SELECT u AS user_id, id AS event_id, '+I' AS row_kind, n AS cnt FROM c WHERE n = 1
    UNION ALL SELECT u, id, '-U', n - 1 FROM c WHERE n > 1 UNION ALL SELECT u, id, '+U', n FROM c WHERE n > 1""",
)
def changelog_counts(spark, folder):
    return count_changes(events(spark, folder).select("user_id", "event_id"), ["user_id"], ["event_id"])


@query("changelog_replay", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def changelog_replay(spark, folder):
    changes = count_changes(events(spark, folder).select("user_id", "event_id"), ["user_id"], ["event_id"])
    return replay(changes, ["user_id"])
