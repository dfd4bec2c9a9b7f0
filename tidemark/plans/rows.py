"""Sources, sinks, row functions and data distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.clock import SECOND, ceil_to, floor_to, idiv, next_tick
from tidemark.functions.text import behavior_row, key_ts_row
from tidemark.operators import distribution, rows
from tidemark.plans.registry import query
from tidemark.session import new_scratch
from tidemark.sinks.writers import labelled, last_per_key
from tidemark.sources import custom
from tidemark.sources.files import declare_table, events, item, table, text_lines


def behavior_lines(df: DataFrame) -> DataFrame:
    """Events written out as ``user,item,category,type,seconds`` lines."""
    parts = ["user_id", item(), F.pmod(item(), F.lit(10)), "event_type", idiv(F.col("us"), SECOND)]
    return df.select(F.concat_ws(",", *[p if isinstance(p, str) else p.cast("string") for p in parts]).alias("value"))


LINE_SQL = "concat_ws(',', u, k, k % 10, t, us // 1000000)"


@query("scan_text", "WITH {E} SELECT " + LINE_SQL + " AS value FROM e")
def scan_text(spark, folder):
    path = new_scratch(spark, "lines")
    behavior_lines(events(spark, folder)).write.text(path)
    return text_lines(spark, path)


@query(
    "literal_rows",
    """SELECT stage, count(*) AS cnt FROM events JOIN (VALUES ('view', 1), ('click', 2), ('purchase', 3))
    AS s(event_type, stage_no) USING (event_type), LATERAL (SELECT CAST(stage_no AS BIGINT) AS stage) GROUP BY stage""",
)
def literal_rows(spark, folder):
    stages = spark.createDataFrame([("view", 1), ("click", 2), ("purchase", 3)], "event_type string, stage bigint")
    # three literal rows: a fixed size, safe to broadcast
    joined = events(spark, folder).select("event_type").join(F.broadcast(stages), "event_type")
    return joined.groupBy("stage").agg(F.count("*").alias("cnt"))


@query("source_replay", "SELECT event_id, epoch_us(ts) AS us, user_id, event_type, value FROM events")
def source_replay(spark, folder):
    custom.register(spark)
    recorded = spark.read.format("recorded_events").option("path", f"{folder}/events.parquet").load()
    timed = recorded.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return timed.select("event_id", "us", "user_id", "event_type", "value")


@query("source_parallel", "SELECT event_id, event_type, subtask FROM events, (VALUES (0), (1)) AS p(subtask)")
def source_parallel(spark, folder):
    twice = distribution.to_every(events(spark, folder), 2)
    return twice.select("event_id", "event_type", F.col("copy").alias("subtask"))


@query("source_partitioned", "SELECT event_id % 2 AS subtask, count(*) AS n, CAST(1 AS BIGINT) AS partitions FROM events GROUP BY 1")
def source_partitioned(spark, folder):
    """Each row once, all rows of a residue in one partition."""
    placed = distribution.to_subtask(events(spark, folder).select("event_id"), 2, F.pmod("event_id", F.lit(2)))
    return _partitions_of(placed, "subtask")


def _replayed(spark, folder, **options):
    custom.register(spark)
    reader = spark.read.format("recorded_events").option("path", f"{folder}/events.parquet").option("pieceBytes", 1 << 16)
    return reader.options(**options).load()


@query("source_subtasks", "SELECT event_id, event_type, true AS mine FROM events")
def source_subtasks(spark, folder):
    """A partition per subtask of the source, each with its own pieces: every row once, and no shuffle."""
    p = _parallelism(spark)
    rows_ = _replayed(spark, folder, subtasks=p)
    return rows_.select("event_id", "event_type", (F.spark_partition_id() == F.col("subtask")).alias("mine"))


@query("source_copies", "SELECT event_id, event_type, copy FROM events, (VALUES (0), (1)) AS p(copy)")
def source_copies(spark, folder):
    """Every subtask of the source twice, each emitting the same rows."""
    p = _parallelism(spark)
    rows_ = _replayed(spark, folder, subtasks=p, copies=2)
    return rows_.select("event_id", "event_type", F.floor(F.col("subtask") / p).cast("int").alias("copy"))


@query("json_scan_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_scan_parse(spark, folder):
    parsed = events(spark, folder).select("event_id", F.from_json("props", "k bigint").alias("p"))
    return parsed.select("event_id", "p.k")


@query("json_filter", "WITH {E} SELECT id AS event_id, k FROM e WHERE k = 7 AND t = 'view'")
def json_filter(spark, folder):
    seven = events(spark, folder).filter((F.col("event_type") == "view") & (item() == 7))
    return seven.select("event_id", item().alias("k"))


@query("sql_ddl_csv", "SELECT user_id AS \"user\", count(event_type) AS cnt FROM events GROUP BY user_id")
def sql_ddl_csv(spark, folder):
    path = new_scratch(spark, "csv")
    events(spark, folder).select("user_id", "event_type").write.csv(path)
    declare_table(spark, "tidemark_csv_clicks", "`user` bigint, url string", "csv", path)
    return spark.sql("SELECT user, count(url) AS cnt FROM tidemark_csv_clicks GROUP BY user")


@query("sql_insert_select", "SELECT user_id AS \"user\", count(event_type) AS cnt FROM events GROUP BY user_id")
def sql_insert_select(spark, folder):
    events(spark, folder).createOrReplaceTempView("tidemark_insert_input")
    target = declare_table(
        spark, "tidemark_result", "`user` bigint, cnt bigint", "parquet", new_scratch(spark, "result")
    )
    spark.sql(
        "INSERT INTO tidemark_result SELECT user_id, count(event_type) FROM tidemark_insert_input GROUP BY user_id"
    )
    return spark.table("tidemark_result").select(*target.columns)


@query("sink_labelled", "SELECT 'clicks' AS label, event_id, user_id FROM events WHERE event_type = 'click'")
def sink_labelled(spark, folder):
    clicks = events(spark, folder).filter(F.col("event_type") == "click")
    return labelled(clicks.select("event_id", "user_id"), "clicks")


@query("sink_upsert_last", "SELECT user_id AS username, arg_max(event_type, event_id) AS url FROM events GROUP BY 1")
def sink_upsert_last(spark, folder):
    rows_ = events(spark, folder).select(F.col("user_id").alias("username"), F.col("event_type").alias("url"), "event_id")
    return last_per_key(rows_, ["username"], ["url"], F.col("event_id"))


@query("map_project", "SELECT user_id FROM events")
def map_project(spark, folder):
    return events(spark, folder).select("user_id")


@query("map_square", "WITH {E} SELECT id AS event_id, k, k * k AS squared FROM e")
def map_square(spark, folder):
    items = events(spark, folder).select("event_id", item().alias("k"))
    return items.withColumn("squared", F.col("k") * F.col("k"))


@query("map_square_lifecycle", "WITH {E} SELECT id AS event_id, k * k AS squared FROM e")
def map_square_lifecycle(spark, folder):
    """The same map as user code with set-up and tear-down once per task."""
    items = events(spark, folder).select("event_id", item().alias("k"))
    return rows.with_lifecycle(
        items,
        "event_id bigint, squared bigint",
        setup=lambda: {"power": 2},
        process=lambda r, b: b.assign(squared=b["k"] ** r["power"])[["event_id", "squared"]],
        teardown=lambda r: r.clear(),
    )


@query(
    "parse_csv_behavior",
    """WITH {E} SELECT CAST(u AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS item_id,
    CAST(k % 10 AS VARCHAR) AS category_id, t AS type, us // 1000000 * 1000000 AS us FROM e""",
)
def parse_csv_behavior(spark, folder):
    return behavior_lines(events(spark, folder)).select(*behavior_row(F.col("value")))


@query("parse_key_ts", "WITH {E} SELECT t AS key, us // 1000000 * 1000000 AS us FROM e")
def parse_key_ts(spark, folder):
    line = F.concat_ws(" ", "event_type", idiv(F.col("us"), SECOND).cast("string"))
    return events(spark, folder).select(line.alias("line")).select(*key_ts_row(F.col("line")))


@query("filter_eq", "SELECT event_id, user_id FROM events WHERE event_type = 'view'")
def filter_eq(spark, folder):
    return events(spark, folder).filter(F.col("event_type") == "view").select("event_id", "user_id")


@query(
    "flatmap_replicate",
    """SELECT event_id, event_type, CAST(unnest(range(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 0 END))
    AS INTEGER) AS copy FROM events""",
)
def flatmap_replicate(spark, folder):
    times = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2).otherwise(0)
    return rows.replicate(events(spark, folder).select("event_id", "event_type"), times)


def texts(spark, folder) -> DataFrame:
    return distribution.spread(table(spark, folder, "documents").select("doc_id", "text"))


TOKENS_SQL = """w AS (SELECT doc_id, CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN [] ELSE
  string_split(rtrim(text, ' '), ' ') END AS ws FROM documents),
  tok AS (SELECT doc_id, CAST(unnest(range(len(ws))) AS INTEGER) AS pos, unnest(ws) AS word FROM w)"""


@query("tokenize", "WITH " + TOKENS_SQL + " SELECT doc_id, pos, word FROM tok")
def tokenize(spark, folder):
    return rows.tokenize(texts(spark, folder))


@query("word_count", "WITH " + TOKENS_SQL + " SELECT word, count(*) AS cnt FROM tok GROUP BY word")
def word_count(spark, folder):
    words = rows.tokenize(texts(spark, folder))
    return words.groupBy("word").agg(F.count("*").alias("cnt"))


@query(
    "scalar_time_math",
    """WITH {E} SELECT id AS event_id, us // 1000000 AS seconds, us % {H} AS in_hour, us // {H} * {H} AS hour_start,
    (us // 1000000 + 1) * 1000000 AS next_second, (us + 999999) // 1000000 * 1000000 AS at_or_after,
    k // 7 AS quotient, k % 7 AS remainder, concat(t, '-', CAST(k AS VARCHAR)) AS joined,
    split_part(concat(t, '-', CAST(k AS VARCHAR)), '-', 2) AS second_part, least(k, 50) AS low, greatest(k, 50) AS high
    FROM e""",
)
def scalar_time_math(spark, folder):
    us, k, hour = F.col("us"), F.col("k"), 3600 * SECOND
    joined = F.concat_ws("-", "event_type", k.cast("string"))
    return events(spark, folder).withColumn("k", item()).select(
        "event_id",
        idiv(us, SECOND).alias("seconds"),
        F.pmod(us, F.lit(hour)).alias("in_hour"),
        floor_to(us, hour).alias("hour_start"),
        next_tick(us, SECOND).alias("next_second"),
        ceil_to(us, SECOND).alias("at_or_after"),
        idiv(k, 7).alias("quotient"),
        (k % 7).alias("remainder"),
        joined.alias("joined"),
        F.split(joined, "-").getItem(1).alias("second_part"),
        F.least(k, F.lit(50)).alias("low"),
        F.greatest(k, F.lit(50)).alias("high"),
    )


@query("udaf_incremental", "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def udaf_incremental(spark, folder):
    """A count written as user code with create, add and merge."""
    counted = rows.custom_aggregate(
        events(spark, folder),
        ["event_type"],
        "event_id",
        "bigint",
        create=lambda: 0,
        add=lambda acc, values: acc + len(values),
        merge=lambda a, b: a + b,
    )
    return counted.withColumnRenamed("acc", "cnt")


def _partitions_of(placed, key: str):
    """In how many partitions the rows of a key are."""
    where = placed.select(key, F.spark_partition_id().alias("p"))
    return where.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct("p").alias("partitions"))


def _spread_of(placed, most: int):
    """Whether rows fill no more than ``most`` partitions, and those evenly."""
    by_partition = placed.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    mean = F.sum("n") / most
    return by_partition.agg(
        F.sum("n").alias("n"),
        (F.count("*") <= most).alias("within"),
        (F.max("n") <= mean + 6 * F.sqrt(mean) + 1).alias("even"),
    )


def _parallelism(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


SPREAD_SQL = "SELECT CAST(count(*) AS BIGINT) AS n, true AS within, true AS even FROM events"


@query("dist_broadcast", "SELECT event_id, CAST(copy AS INTEGER) AS copy FROM events, (VALUES (0), (1)) AS p(copy)")
def dist_broadcast(spark, folder):
    return distribution.to_every(events(spark, folder).select("event_id"), 2)


@query("dist_shuffle", SPREAD_SQL)
def dist_shuffle(spark, folder):
    p = _parallelism(spark)
    return _spread_of(distribution.shuffle(events(spark, folder).select("event_id", "user_id"), p, "event_id"), p)


@query("dist_rebalance", SPREAD_SQL)
def dist_rebalance(spark, folder):
    p = _parallelism(spark)
    return _spread_of(distribution.rebalance(events(spark, folder).select("event_id", "user_id"), p), p)


@query("dist_rescale", "SELECT CAST(count(*) AS BIGINT) AS n, true AS within FROM events")
def dist_rescale(spark, folder):
    p = _parallelism(spark)
    return _spread_of(distribution.rescale(events(spark, folder).select("event_id", "user_id"), p), p).select("n", "within")


@query("dist_hash", "SELECT user_id, count(*) AS n, CAST(1 AS BIGINT) AS partitions FROM events GROUP BY user_id")
def dist_hash(spark, folder):
    """All rows of a key in one partition."""
    placed = distribution.by_key(events(spark, folder).select("event_id", "user_id"), _parallelism(spark), "user_id")
    return _partitions_of(placed, "user_id")
