"""Time windows. Times in and out are epoch microseconds, windows are epoch-aligned [start, end)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.clock import ceil_to, floor_to, idiv, interval, next_tick


def bounds(window: Column = None) -> list[Column]:
    window = F.col("window") if window is None else window
    return [
        F.unix_micros(window["start"]).alias("window_start"),
        F.unix_micros(window["end"]).alias("window_end"),
    ]


def tumbling(df: DataFrame, keys: list[str], size: int, aggs: list[Column], ts: str = "ts") -> DataFrame:
    """Aggregates per key and window of ``size``; ``keys=[]`` is the window over everything.

    Partial aggregation runs before the shuffle, so neither a hot key nor the keyless form
    overloads a task. Batch, or streaming with a watermark on ``ts``.
    """
    grouped = df.groupBy(*keys, F.window(ts, interval(size))).agg(*aggs)
    return grouped.select(*keys, *bounds(), *[c for c in grouped.columns if c not in (*keys, "window")])


def tumbling_by_hand(df: DataFrame, keys: list[str], size: int, us: str = "us") -> DataFrame:
    """Tumbling counts from plain arithmetic on the time column (batch)."""
    start = floor_to(F.col(us), size).alias("window_start")
    counts = df.groupBy(*keys, start).agg(F.count("*").alias("cnt"))
    return counts.withColumn("window_end", F.col("window_start") + F.lit(size))


def sliding_counts(df: DataFrame, keys: list[str], size: int, slide: int, ts: str = "ts", us: str = "us") -> DataFrame:
    """Counts per key and window of ``size`` starting every ``slide``.

    Batch with a whole number of slides per window: rows are counted once per pane of one slide,
    and only the pane counts are copied into the windows that cover them, so the input is not
    multiplied by size/slide. Otherwise Spark's window() expands the rows.
    """
    if df.isStreaming or size % slide:
        grouped = df.groupBy(*keys, F.window(ts, interval(size), interval(slide))).agg(F.count("*").alias("cnt"))
        return grouped.select(*keys, *bounds(), "cnt")
    panes = df.groupBy(*keys, floor_to(F.col(us), slide).alias("pane")).agg(F.count("*").alias("n"))
    first = F.col("pane") - F.lit(size - slide)
    covering = panes.withColumn("window_start", F.explode(F.sequence(first, F.col("pane"), F.lit(slide))))
    counts = covering.groupBy(*keys, "window_start").agg(F.sum("n").alias("cnt"))
    return counts.select(*keys, "window_start", (F.col("window_start") + F.lit(size)).alias("window_end"), "cnt")


def sessions(df: DataFrame, keys: list[str], gap: int, us: str = "us") -> DataFrame:
    """Session windows: rows of a key at most ``gap`` apart belong together.

    Two rows in one slot of width ``gap`` are always closer than ``gap``, so slots are aggregated
    first (partial aggregation before the shuffle) and only slot rows - at most time span / gap per
    key, however many rows the key has - are ordered and merged.
    """
    slots = df.groupBy(*keys, idiv(floor_to(F.col(us), gap), gap).alias("slot")).agg(
        F.min(us).alias("lo"), F.max(us).alias("hi"), F.count("*").alias("n")
    )
    w = Window.partitionBy(*keys).orderBy("slot")
    opens = F.col("lo") - F.lag("hi").over(w)
    marked = slots.withColumn("opens", F.when(opens <= F.lit(gap), 0).otherwise(1))
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn("session", F.sum("opens").over(so_far))
    return (
        numbered.groupBy(*keys, "session")
        .agg(F.min("lo").alias("window_start"), F.max("hi").alias("hi"), F.sum("n").alias("cnt"))
        .select(*keys, "window_start", (F.col("hi") + F.lit(gap)).alias("window_end"), "cnt")
    )


def sessions_stream(df: DataFrame, keys: list[str], gap: int, ts: str = "ts") -> DataFrame:
    """Session windows on a stream with a watermark (Spark's session_window)."""
    grouped = df.groupBy(*keys, F.session_window(ts, interval(gap)).alias("window")).agg(F.count("*").alias("cnt"))
    return grouped.select(*keys, *bounds(), "cnt")


def early_fires(df: DataFrame, keys: list[str], size: int, tick: int, us: str = "us") -> DataFrame:
    """Cumulative counts of each tumbling window at every whole ``tick`` before its end, from the
    first tick after its first row, plus the complete count at ``end - 1``.

    Rows are counted per (key, window, tick slot) before any ordering; a window has size/tick slots.
    """
    ws = floor_to(F.col(us), size)
    end = F.col("window_start") + F.lit(size)
    slots = df.groupBy(*keys, ws.alias("window_start"), ceil_to(F.col(us), tick).alias("slot")).agg(
        F.count("*").alias("n"), F.min(us).alias("lo")
    )
    w = Window.partitionBy(*keys, "window_start").orderBy("slot")
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = slots.select(
        *keys,
        "window_start",
        F.sum("n").over(up_to).alias("cnt"),
        # a slot's count holds from its own tick (the first row's next tick at the earliest) ...
        F.greatest(F.col("slot"), next_tick(F.min("lo").over(up_to), tick)).alias("from_tick"),
        # ... until the tick before the next slot with rows, inside the window
        F.least(F.lead("slot").over(w) - F.lit(tick), end - F.lit(1)).alias("to_tick"),
        F.lead("slot").over(w).isNull().alias("is_last"),
    )
    some = F.col("from_tick") <= F.col("to_tick")
    ticks = F.when(some, F.sequence(F.col("from_tick"), F.col("to_tick"), F.lit(tick)))
    final = F.when(F.col("is_last"), F.array(end - F.lit(1)))
    none = F.array().cast("array<bigint>")
    fires = F.concat(F.coalesce(ticks, none), F.coalesce(final, none))
    return so_far.select(*keys, "window_start", F.explode(fires).alias("fired_at"), "cnt")
