"""How big is an input? Used before anything is broadcast or left unsplit."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import new_scratch

# Inputs below this estimate fit one task whatever their keys look like.
SMALL_INPUT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate for ``df``, or None where the session cannot be asked."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame) -> bool:
    limit = int(df.sparkSession.conf.get("spark.tidemark.smallInputBytes", str(SMALL_INPUT_BYTES)))
    size = estimated_bytes(df)
    return size is not None and size <= limit


def settle(df: DataFrame) -> DataFrame:
    """A result that several later steps read: written once to the shared scratch folder, so it is
    neither computed again nor lost with an executor. Small inputs are cheaper to compute again."""
    if is_small(df):
        return df
    path = new_scratch(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
