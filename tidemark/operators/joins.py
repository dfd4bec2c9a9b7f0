"""Joins of tables and streams on keys and time.

No side is broadcast by hint: Spark broadcasts a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merges with adaptive skew splitting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import floor_to, idiv
from tidemark.operators.ordered import running


def inner_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All pairs of rows with equal keys, over the full history of both sides. Batch or streaming."""
    return left.join(right, keys)


def matches_per_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many pairs ``inner_join`` has per key, without making the pairs."""
    counts = [s.groupBy(key).agg(F.count("*").alias(n)) for s, n in ((left, "n_left"), (right, "n_right"))]
    return counts[0].join(counts[1], key).select(key, (F.col("n_left") * F.col("n_right")).alias("pairs"))


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_us: str, right_us: str, before: int, after: int
) -> DataFrame:
    """Pairs with equal keys and ``right_us`` in [left_us - before, left_us + after], ends included.

    Time is cut into buckets as long as the interval: a left row reaches at most two of them, and
    rows meet per (key, bucket), so a hot key is spread over its buckets and only nearby rows are
    compared. Adaptive execution splits a bucket that is still too big.
    """
    width = max(before + after, 1)

    def bucket(us: Column) -> Column:
        return idiv(floor_to(us, width), width)

    lo, hi = F.col(left_us) - F.lit(before), F.col(left_us) + F.lit(after)
    reach = left.withColumn("__b", F.explode(F.sequence(bucket(lo), bucket(hi))))
    placed = right.withColumn("__b", bucket(F.col(right_us)))
    near = F.col(right_us).between(lo, hi)
    return _equi(reach, placed, [*keys, "__b"], near).drop("__b")


def window_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_us: str, right_us: str, size: int
) -> DataFrame:
    """Pairs with equal keys in the same tumbling window, which is added as ``window_start``."""
    a = left.withColumn("window_start", floor_to(F.col(left_us), size))
    b = right.withColumn("window_start", floor_to(F.col(right_us), size))
    return a.join(b, [*keys, "window_start"])


def _equi(left: DataFrame, right: DataFrame, keys: list[str], extra: Column, how: str = "inner") -> DataFrame:
    renamed = reduce(lambda d, k: d.withColumnRenamed(k, f"__r_{k}"), keys, right)
    same = [left[k] == renamed[f"__r_{k}"] for k in keys]
    return left.join(renamed, reduce(lambda x, y: x & y, same) & extra, how).drop(*[f"__r_{k}" for k in keys])


def latest_control(data: DataFrame, control: DataFrame, keys: list[str], us: str, value: str) -> DataFrame:
    """Give each data row the newest control ``value`` at or before its time (null before the first).

    ``keys=[]`` is one control value for everything. Data and control rows go through one ordered
    pass, so neither side has to be small and no range join is made. At equal times control rows
    come in their order of ``prio`` (0 by default) and before data rows.
    """
    marks = control if "prio" in control.columns else control.withColumn("prio", F.lit(0))
    marks = marks.select(*keys, us, "prio", value)
    payload = [c for c in data.columns if c not in (*keys, us)]
    rows = data.select(*keys, us, F.lit(1 << 30).alias("prio"), F.struct(*payload).alias("__row"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    held = running(both, keys, [us, "prio"], {"__held": ("last", F.col(value))})
    return held.filter(F.col("__row").isNotNull()).select(*keys, us, "__row.*", F.col("__held").alias(value))


def gate(data: DataFrame, opened: DataFrame, keys: list[str], us: str, duration: int) -> DataFrame:
    """Data rows that find the gate of their key open: an opening row opens it for ``duration``,
    and the end of any opening closes it. Open at the opening instant, closed at the closing one."""
    marker = F.explode(
        F.array(
            F.struct(F.col(us).alias("t"), F.lit(0).alias("prio"), F.lit(True).alias("open")),
            F.struct((F.col(us) + F.lit(duration)).alias("t"), F.lit(1).alias("prio"), F.lit(False).alias("open")),
        )
    )
    marks = opened.select(*keys, marker.alias("m")).select(*keys, F.col("m.t").alias(us), "m.prio", "m.open")
    return latest_control(data, marks, keys, us, "open").filter("open").drop("open")


def number_per_key(df: DataFrame, keys: list[str], order: list[str], name: str = "n") -> DataFrame:
    """1, 2, 3, ... per key in the given order."""
    return running(df, keys, order, {name: ("count", F.lit(1))})


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], left_us: str, right_us: str, timeout: int
) -> DataFrame:
    """Match rows of two sides (at most one per key and side) no more than ``timeout`` apart.

    ``outcome`` is left_first, right_first, left_only or right_only.
    """
    close = F.abs(F.col(left_us) - F.col(right_us)) <= F.lit(timeout)
    r = reduce(lambda d, k: d.withColumnRenamed(k, f"__r_{k}"), keys, right)
    same = reduce(lambda x, y: x & y, [left[k] == r[f"__r_{k}"] for k in keys])
    both = left.join(r, same & close, "full_outer")
    outcome = (
        F.when(F.col(left_us).isNull(), "right_only")
        .when(F.col(right_us).isNull(), "left_only")
        .when(F.col(left_us) <= F.col(right_us), "left_first")
        .otherwise("right_first")
    )
    merged = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys]
    rest = [c for c in both.columns if c not in keys and not c.startswith("__r_")]
    return both.select(*merged, *rest, outcome.alias("outcome"))
