"""Streaming forms that Spark's own stateful operators express.

``windows.tumbling``, ``windows.sliding_counts``, ``windows.sessions_stream``, ``distinct.uv_exact``,
``distinct.uv_sketch`` and ``joins.inner_join`` take a stream with a watermark as they are. Here are
the forms that differ from their batch twins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import interval
from tidemark.operators import joins, topn, watermarks
from tidemark.operators.windows import bounds, sliding_counts
from tidemark.sinks.writers import batch_files
from tidemark.streaming.run import Carried


def hot_items_writer(n: int, item: str) -> Callable[[str], Callable]:
    """foreachBatch writer for closed window counts. All counts of a window leave the append-mode
    aggregate in one micro-batch, so the batch top-N over it is the top-N of the window."""

    def best(counts: DataFrame) -> DataFrame:
        return topn.top_n(counts, ["window_start", "window_end"], [F.col("cnt").desc(), F.col(item)], n)

    return lambda path: batch_files(path, best)


def hot_item_counts(df: DataFrame, item: str, size: int, slide: int) -> DataFrame:
    return sliding_counts(df, [item], size, slide)


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, before: int, after: int
) -> DataFrame:
    """Interval join of two streams with watermarks; the time condition bounds the state."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.expr(
        " AND ".join(
            [*[f"{k} = __r_{k}" for k in keys]]
            + [
                f"{right_ts} >= {left_ts} - INTERVAL {interval(before)}",
                f"{right_ts} <= {left_ts} + INTERVAL {interval(after)}",
            ]
        )
    )
    return left.join(renamed, condition).drop(*[f"__r_{k}" for k in keys])


def window_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, size: int) -> DataFrame:
    """Window join of two streams with watermarks: each side keeps only its window as event time."""
    a = left.withColumn("window", F.window(left_ts, interval(size))).drop(left_ts)
    b = right.withColumn("window", F.window(right_ts, interval(size))).drop(right_ts)
    joined = a.join(b, [*keys, "window"])
    return joined.select(*keys, bounds()[0], *[c for c in joined.columns if c not in (*keys, "window")])


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, timeout: int) -> DataFrame:
    """Full outer interval join of two streams with watermarks, labelled like ``joins.reconcile``."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    span = interval(timeout)
    condition = " AND ".join(
        [*[f"{k} = __r_{k}" for k in keys]]
        + [f"{right_ts} >= {left_ts} - INTERVAL {span}", f"{right_ts} <= {left_ts} + INTERVAL {span}"]
    )
    both = left.join(r, F.expr(condition), "full_outer")
    lt, rt = F.col(left_ts), F.col(right_ts)
    outcome = F.when(lt.isNull(), "right_only").when(rt.isNull(), "left_only").when(lt <= rt, "left_first")
    merged = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys]
    return both.select(
        *merged, F.unix_micros(lt).alias("left_us"), F.unix_micros(rt).alias("right_us"),
        outcome.otherwise("right_first").alias("outcome"),
    )


def group_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key for update mode: each changed key once per micro-batch. Write the changes with
    ``group_counts_writer``, or keep the newest with ``writers.upsert_table`` (a count only grows, so it is
    its own sequence number)."""
    return df.groupBy(*keys).agg(F.count("*").alias("cnt"))


def group_counts_writer() -> Callable[[str], Callable]:
    return batch_files


def late_router(path: str, arrival: list[str], delay: int, us: str = "us") -> Callable[[DataFrame, int], None]:
    """foreachBatch function splitting late rows from the others, record by record.

    The watermark of each row is a running maximum inside the micro-batch on top of the maximum of
    all earlier batches, which is carried over. Both outputs leave in one write, told apart by the
    column ``output`` (a folder each): main and late.
    """
    carried = Carried(f"{path}/seen", ["top"])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = carried.before(spark, batch_id)
        top = F.lit(was["top"] if was else None).cast("bigint")
        batch = batch.persist()
        seen = watermarks.with_watermark_before(batch, arrival, delay, us)
        seen = seen.withColumn("wm_before", F.greatest("wm_before", top - F.lit(delay + 1)))
        tagged = seen.withColumn("output", F.when(watermarks.late(us), "late").otherwise("main"))
        batch_files(f"{path}/out", by=["output"])(tagged.drop("wm_before"), batch_id)
        newest = batch.agg(F.greatest(F.max(us), top).alias("top")).first()["top"]
        carried.save(spark, batch_id, (newest,))
        batch.unpersist()

    return write


def control_filter(
    path: str, is_control: Column, us: str, value: str, keep: Column
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: data rows that pass ``keep`` given the newest control ``value``.

    One stream holds data and control rows in event-time order of its batches; the last control
    value of earlier batches is carried over.
    """
    carried = Carried(f"{path}/control", [us, value])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = carried.before(spark, batch_id)
        batch = batch.persist()
        control = batch.filter(is_control).select(us, value)
        newest = control.agg(F.max(F.struct(us, value)).alias("n")).first()["n"] or was
        if was is not None and was[0] > newest[0]:  # micro-batches may come out of order
            newest = was
        if was is not None:
            control = control.unionByName(spark.createDataFrame([tuple(was)], control.schema))
        data = batch.filter(~is_control).drop(value)
        held = joins.latest_control(data, control, [], us, value)
        batch_files(f"{path}/out")(held.filter(keep), batch_id)
        if newest is not None:
            carried.save(spark, batch_id, tuple(newest))
        batch.unpersist()

    return write
