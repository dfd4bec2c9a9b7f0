"""Watermarks and lateness with one exact meaning.

Rows come in arrival order. Before a row, the watermark is (largest event time of all earlier rows)
- delay - 1 microsecond; it is null before the first row. That is a running maximum over everything,
computed in chunks of the arrival order (see ``ordered``), never in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import floor_to
from tidemark.functions.sizing import settle
from tidemark.operators.ordered import running


def with_watermark_before(df: DataFrame, arrival: list[str], delay: int, us: str = "us") -> DataFrame:
    """Add ``wm_before``, the watermark a row meets on arrival."""
    seen = running(df, [], arrival, {"wm_before": ("max", F.col(us))}, before=True)
    return seen.withColumn("wm_before", F.col("wm_before") - F.lit(delay + 1))


def watermark_trace(df: DataFrame, arrival: list[str], delay: int, us: str = "us") -> DataFrame:
    """``wm_before`` and ``wm_after`` of every row; delay 0 is the monotonous watermark."""
    seen = with_watermark_before(df, arrival, delay, us)
    return seen.withColumn("wm_after", F.greatest("wm_before", F.col(us) - F.lit(delay + 1)))


def punctuated_trace(df: DataFrame, arrival: list[str], carries: Column, us: str = "us") -> DataFrame:
    """Watermark that only rows with ``carries`` advance, to their time - 1."""
    mark = F.when(carries, F.col(us) - F.lit(1))
    return running(df, [], arrival, {"wm_after": ("max", mark)})


def min_watermark_trace(df: DataFrame, arrival: list[str], is_left: Column, us: str = "us") -> DataFrame:
    """Watermark of a union of two inputs: the smaller of the two, null until both have a row."""
    aggs = {
        "left_max": ("max", F.when(is_left, F.col(us))),
        "right_max": ("max", F.when(~is_left, F.col(us))),
    }
    seen = running(df, [], arrival, aggs)
    both = F.col("left_max").isNotNull() & F.col("right_max").isNotNull()
    wm = F.when(both, F.least("left_max", "right_max") - F.lit(1))
    return seen.withColumn("wm_after", wm).drop("left_max", "right_max")


def late(us: str = "us") -> Column:
    """A row is late when its time is below the watermark it meets; the first row never is."""
    return F.coalesce(F.col(us) < F.col("wm_before"), F.lit(False))


def window_fate(size: int, lateness: int = 0, us: str = "us") -> list[Column]:
    """Window end of a row and its fate there: on_time, accepted (late but allowed) or dropped."""
    end = floor_to(F.col(us), size) + F.lit(size)
    last, wm = end - F.lit(1), F.col("wm_before")
    fate = F.when(wm.isNull() | (last > wm), "on_time").when(last + F.lit(lateness) > wm, "accepted")
    return [end.alias("window_end"), fate.otherwise("dropped").alias("fate")]


def window_late_counts(df: DataFrame, keys: list[str], arrival: list[str], delay: int, size: int) -> DataFrame:
    """Per key and window: rows counted in the window, and rows that came after it had closed."""
    seen = with_watermark_before(df, arrival, delay).select(*keys, *window_fate(size))
    return seen.groupBy(*keys, "window_end").agg(
        F.count_if(F.col("fate") == "on_time").alias("cnt"),
        F.count_if(F.col("fate") == "dropped").alias("late"),
    )


def allowed_lateness(
    df: DataFrame, keys: list[str], arrival: list[str], delay: int, size: int, lateness: int
) -> DataFrame:
    """Every firing of every window: the first one, one more per allowed late row, and the number
    of rows too late even for that.

    The watermark only grows, so within a window all on-time rows precede all accepted ones and a
    firing's count is a running count of the rows kept.
    """
    seen = settle(with_watermark_before(df, arrival, delay).select(*keys, *arrival, *window_fate(size, lateness)))
    group = [*keys, "window_end"]
    on_time = F.col("fate") == "on_time"
    totals = seen.groupBy(*group).agg(
        F.count_if(on_time).alias("on_time"), F.count_if(F.col("fate") == "dropped").alias("dropped")
    )

    def entry(fire: Column, cnt: str, kind: str) -> Column:
        return F.struct(fire.cast("bigint").alias("fire"), F.col(cnt).alias("cnt"), F.lit(kind).alias("kind"))

    whole = F.array(
        F.when(F.col("on_time") > 0, entry(F.lit(0), "on_time", "first")),
        F.when(F.col("dropped") > 0, entry(F.lit(None), "dropped", "side_output")),
    )
    per_window = totals.select(*group, F.explode(F.array_compact(whole)).alias("f")).select(*group, "f.*")
    kept = running(
        seen.filter(F.col("fate") != "dropped"),
        group,
        arrival,
        {"cnt": ("count", F.lit(1)), "n0": ("count", F.when(on_time, 1))},
    )
    again = kept.filter(~on_time).select(
        *group,
        (F.col("cnt") - F.col("n0")).alias("fire"),
        "cnt",
        F.when((F.col("n0") == 0) & (F.col("cnt") == 1), "first").otherwise("refire").alias("kind"),
    )
    return per_window.unionByName(again)


def element_timers(df: DataFrame, keys: list[str], after: int, us: str = "us") -> DataFrame:
    """One timer per key and instant ``us + after``; fired if the final watermark (delay 0) is there."""
    final = df.agg(F.max(us) - F.lit(1)).scalar()
    timers = df.select(*keys, (F.col(us) + F.lit(after)).alias("timer")).distinct()
    return timers.withColumn("fired", F.col("timer") <= final)
