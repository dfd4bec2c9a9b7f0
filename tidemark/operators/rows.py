"""Row-wise operators: map, filter, replicate, tokenise, and user code with a lifecycle.

Plain column expressions; every one works on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import tokens


def replicate(df: DataFrame, copies: Column) -> DataFrame:
    """Emit each row ``copies`` times (0 drops it), numbered from 0 in ``copy``."""
    numbers = F.sequence(F.lit(0), copies - 1)
    none = F.array().cast("array<int>")
    return df.withColumn("copy", F.explode(F.when(copies > 0, numbers).otherwise(none)))


def tokenize(df: DataFrame, text: str = "text", sep: str = " ") -> DataFrame:
    """One row per token with its position in the text; the text itself is dropped."""
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.posexplode(tokens(F.col(text), sep)).alias("pos", "word"))


def lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of the text with its position."""
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))


def with_lifecycle(
    df: DataFrame,
    schema,
    setup: Callable[[], object],
    process: Callable[[object, pd.DataFrame], pd.DataFrame],
    teardown: Callable[[object], None],
) -> DataFrame:
    """Run user code over Arrow batches with one ``setup`` and one ``teardown`` per task."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield process(resource, batch)
        finally:
            teardown(resource)

    return df.mapInPandas(task, schema)


def custom_aggregate(
    df: DataFrame,
    keys: list[str],
    value: str | list[str],
    acc_type: str,
    add: Callable[[object, pd.Series | pd.DataFrame], object],
    merge: Callable[[object, object], object],
    create: Callable[[], object],
    max_keys_held: int = 100_000,
) -> DataFrame:
    """A user-defined incremental aggregate (create / add / merge) in two steps.

    Each task folds its batches into one accumulator per key before the shuffle, so a hot key ships
    one small row per task. Partial accumulators are merged in two rounds, first spread over 64
    salts (by task, so a task that runs again sends them to the same place): no task meets all
    partials of a hot key. Built-in aggregates are faster; this is for code Spark has no aggregate
    for. ``add`` gets a series of ``value``, or a frame for a list of columns. The result column is ``acc``.
    """
    key_schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def rows(held: dict) -> pd.DataFrame:
        out = pd.DataFrame([list(k) for k in held], columns=keys)
        out["acc"] = list(held.values())
        return out

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, object] = {}
        for batch in batches:
            for key, part in batch.groupby(keys, dropna=False, sort=False)[value]:
                held[key] = add(held[key] if key in held else create(), part)
            if len(held) > max_keys_held:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    def merged(batch: pd.DataFrame) -> pd.DataFrame:
        total = create()
        for acc in batch["acc"]:
            total = merge(total, acc)
        return batch.head(1).assign(acc=[total])

    values = [value] if isinstance(value, str) else value
    partial = df.select(*keys, *values).mapInPandas(fold, f"{key_schema}, acc {acc_type}")
    salted = partial.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = salted.groupBy(*keys, "salt").applyInPandas(merged, salted.schema)
    second = first.drop("salt")
    return second.groupBy(*keys).applyInPandas(merged, second.schema)
