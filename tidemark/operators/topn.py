"""Best rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.windows import sliding_counts


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per group. Spark keeps only n rows per group and task before the shuffle
    (WindowGroupLimit), so a group of any size is safe."""
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("bigint"))


def top1(df: DataFrame, group: list[str], item: str, count: str) -> DataFrame:
    """Item with the highest count per group, the smaller item on a tie: an aggregate, not a sort."""
    best = F.min(F.struct((-F.col(count)).alias("neg"), F.col(item).alias("item")))
    found = df.groupBy(*group).agg(best.alias("best"))
    return found.select(*group, F.col("best.item").alias(item), (-F.col("best.neg")).alias(count))


def hot_items(df: DataFrame, item: str, size: int, slide: int, n: int) -> DataFrame:
    """Most counted items of every sliding window (batch)."""
    counts = sliding_counts(df, [item], size, slide)
    return top_n(counts, ["window_start", "window_end"], [F.col("cnt").desc(), F.col(item)], n)
