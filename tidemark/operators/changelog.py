"""Changelog of an updating aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import running


def count_changes(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row kinds of ``count(*) group by keys``: +I for the first row of a key, then -U old, +U new."""
    counted = running(df, keys, order, {"n": ("count", F.lit(1))})

    def change(kind: str, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("row_kind"), n.cast("bigint").alias("cnt"))

    n = F.col("n")
    changes = F.when(n == 1, F.array(change("+I", n))).otherwise(F.array(change("-U", n - 1), change("+U", n)))
    return counted.select(*keys, *order, F.explode(changes).alias("c")).select(*keys, *order, "c.*")


def replay(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Fold a changelog back into its table: inserts and new values minus retracted ones."""
    sign = F.when(F.col("row_kind").isin("+I", "+U"), 1).otherwise(-1)
    return changes.groupBy(*keys).agg(F.sum(sign * F.col("cnt")).alias("cnt"))
