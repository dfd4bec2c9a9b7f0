"""Tumbling windows with allowed lateness and a side output for late rows, exact record by record.

Spark moves its watermark once per micro-batch and drops what is late. Here the watermark moves with every
row: inside a micro-batch it is a running maximum over the rows in their order of arrival (computed in
chunks over all cores, see ``operators.ordered``) on top of the maximum of all earlier batches, which is
carried. So a row's fate does not depend on where micro-batches begin:

* ``on_time``: its window was open; the window fires its first count when the watermark passes its end,
* ``accepted``: late by no more than ``lateness``; the window fires again with the new count,
* ``dropped``: goes to the side output as it is.

State is three counts per key and open window, never rows, in a ``VersionedTable``. Rows of one micro-batch are
counted with partial aggregation before they meet the state, and the firings of accepted rows are
numbered by a running count that survives hot keys, so a hot window is not one task's work. A window leaves the
state when the watermark has passed its end and the lateness.

Two outputs under ``path``, a folder per micro-batch, replaced when a batch runs again:
``fired`` (keys, window_end, fire, cnt, kind) and ``late`` (keys, arrival columns, time, window_end).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.ordered import running
from tidemark.operators.watermarks import window_fate, with_watermark_before
from tidemark.sinks.versioned import VersionedTable
from tidemark.sinks.writers import batch_files
from tidemark.streaming.run import Carried

_COUNTS = ("on_time", "accepted")


def late_windows_writer(
    path: str, keys: dict[str, str], arrival: list[str], delay: int, size: int, lateness: int = 0, us: str = "us"
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function; ``keys`` are names and SQL types. ``lateness=0`` is the plain late side output of a
    window: nothing is accepted late."""
    carried = Carried(f"{path}/seen", ["top"])
    names = list(keys)
    group = [*names, "window_end"]
    typed = ", ".join(f"{k} {t}" for k, t in keys.items())
    schema = f"{typed}, window_end bigint, batch bigint, on_time bigint, accepted bigint, fired boolean"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = carried.before(spark, batch_id)
        top = F.lit(was["top"] if was else None).cast("bigint")
        batch = batch.select(*names, *arrival, us).persist()
        seen = with_watermark_before(batch, arrival, delay, us)
        seen = seen.withColumn("wm_before", F.greatest("wm_before", top - F.lit(delay + 1)))
        fated = seen.select(*names, *arrival, us, *window_fate(size, lateness, us)).persist()
        newest = batch.agg(F.greatest(F.max(us), top).alias("top")).first()["top"]
        if newest is None:
            return
        state = VersionedTable(spark, f"{path}/state", group, "batch", schema)
        windows = _merged(state.read(before=batch_id), fated, group, newest - delay - 1).persist()
        fired = _first(windows, group).unionByName(_again(fated, windows, names, arrival))
        batch_files(f"{path}/fired")(fired, batch_id)
        batch_files(f"{path}/late")(fated.filter(F.col("fate") == "dropped").drop("fate"), batch_id)
        changed = windows.filter("due OR new_on_time > 0 OR new_accepted > 0")
        changed = changed.select(*group, F.lit(batch_id).cast("bigint").alias("batch"), *_COUNTS, "fired")
        state.merge(changed, batch_id, keep=F.col("window_end") - 1 + F.lit(lateness) > F.lit(newest - delay - 1))
        carried.save(spark, batch_id, (newest,))
        for used in (windows, fated, batch):
            used.unpersist()

    return write


def _merged(state: DataFrame, fated: DataFrame, group: list[str], watermark: int) -> DataFrame:
    """Open windows with their counts before (``old_``), in (``new_``) and after this batch; ``due`` windows fire now.
    Null keys are keys like any other."""
    new = fated.filter(F.col("fate") != "dropped").groupBy(*group).agg(
        *[F.count_if(F.col("fate") == c).alias(f"new_{c}") for c in _COUNTS]
    )
    old = state.select(*[F.col(c).alias(f"old_{c}") for c in (*group, *_COUNTS)], F.col("fired").alias("was_fired"))
    same = _same(new, old, group)
    both = new.join(old, same, "full_outer")
    both = both.select(
        *[F.coalesce(c, f"old_{c}").alias(c) for c in group],
        *[F.coalesce(x, F.lit(0)).alias(x) for c in _COUNTS for x in (f"new_{c}", f"old_{c}")],
        F.coalesce("was_fired", F.lit(False)).alias("was_fired"),
    )
    over = F.col("window_end") - 1 <= F.lit(watermark)
    both = both.withColumns({c: F.col(f"old_{c}") + F.col(f"new_{c}") for c in _COUNTS})
    return both.withColumns({"due": over & ~F.col("was_fired"), "fired": over | F.col("was_fired")})


def _same(a: DataFrame, b: DataFrame, group: list[str], prefix: str = "old_") -> Column:
    same = F.lit(True)
    for c in group:
        same = same & a[c].eqNullSafe(b[f"{prefix}{c}"])
    return same


def _first(windows: DataFrame, group: list[str]) -> DataFrame:
    """First firings. The watermark only grows, so all on-time rows of a window came before it passed the end."""
    due = windows.filter("due AND on_time > 0")
    return due.select(*group, F.lit(0).cast("bigint").alias("fire"), F.col("on_time").alias("cnt"), F.lit("first").alias("kind"))


def _again(fated: DataFrame, windows: DataFrame, names: list[str], arrival: list[str]) -> DataFrame:
    """One firing per accepted row, numbered on from the firings of earlier batches."""
    group = [*names, "window_end"]
    accepted = fated.filter(F.col("fate") == "accepted").select(*group, *arrival)
    numbered = running(accepted, group, arrival, {"n": ("count", F.lit(1))}).select(*group, "n")
    base = windows.filter("new_accepted > 0").select(*[F.col(c).alias(f"w_{c}") for c in group], "old_accepted", "on_time")
    rows = numbered.join(base, _same(numbered, base, group, "w_"))
    fire = F.col("old_accepted") + F.col("n")
    kind = F.when((F.col("on_time") == 0) & (fire == 1), "first").otherwise("refire")
    return rows.select(*group, fire.alias("fire"), (F.col("on_time") + fire).alias("cnt"), kind.alias("kind"))


def fired(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/fired").drop("batch")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/late").drop("batch")
