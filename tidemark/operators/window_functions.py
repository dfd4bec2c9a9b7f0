"""User code over the elements of a window.

Two ways, for code that Spark has no aggregate for:

* ``aggregate_window``: an accumulator (create, add, merge) per key and window, folded in every task before the
  shuffle and merged in two rounds, then a function that sees the result together with the bounds of the window.
  A hot window ships one accumulator per task.
* ``process_window``: a function that sees all elements of a window in order of time, as an iterator of
  batches. Spark sorts them (spilling to disk) and hands them over piece by piece, so a window may be larger
  than memory; it is one task's work, as the function asks for all of it in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.clock import floor_to
from tidemark.operators.rows import custom_aggregate

Rows = Iterable[tuple]


class Accumulator:
    """What a window has seen so far. ``sql_type`` is the type under which it travels between tasks."""

    sql_type: str

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, elements: pd.DataFrame) -> Any:
        """``acc`` after some more elements of the window, in no particular order."""
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError


def _with_window(df: DataFrame, size: int, us: str) -> DataFrame:
    return df.withColumn("window_start", floor_to(F.col(us), size))


def _key_schema(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def aggregate_window(
    df: DataFrame,
    keys: list[str],
    size: int,
    columns: list[str],
    accumulator: Accumulator,
    finish: Callable[[tuple, int, int, Any], Rows],
    output: str,
    us: str = "us",
) -> DataFrame:
    """Rows ``finish(key, start, end, acc)`` of every key and tumbling window, behind keys, window_start and
    window_end. ``output`` are the columns that ``finish`` gives. An empty table gives no rows; null keys
    are a key."""
    rows = _with_window(df, size, us)
    group = [*keys, "window_start"]
    a = accumulator
    merged = custom_aggregate(rows, group, columns, a.sql_type, create=a.create, add=a.add, merge=a.merge)

    def attach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (*key, start, start + size, *row)
                for *key, start, acc in batch[[*group, "acc"]].itertuples(index=False)
                for row in finish(tuple(key), start, start + size, acc)
            ]
            if out:
                yield pd.DataFrame(out, columns=names)

    schema = f"{_key_schema(df, keys)}window_start bigint, window_end bigint, {output}"
    names = [*keys, "window_start", "window_end", *[c.split()[0] for c in output.split(", ")]]
    return merged.mapInPandas(attach, schema)


def process_window(
    df: DataFrame,
    keys: list[str],
    size: int,
    columns: list[str],
    function: Callable[[tuple, int, int, Iterator[pd.DataFrame]], Rows],
    output: str,
    order: list[str] | None = None,
    us: str = "us",
) -> DataFrame:
    """Rows ``function(key, start, end, elements)`` of every key and tumbling window, behind keys, window_start
    and window_end. ``elements`` are batches of ``columns`` in ascending ``order`` (time, if not given)."""
    group = [*keys, "window_start"]
    order = order or [us]
    wanted = list(dict.fromkeys([*group, *columns, *order]))
    rows = _with_window(df, size, us).select(*wanted)
    # The order of the exchange below covers that of the grouping, so Spark sorts once.
    rows = rows.repartition(*group).sortWithinPartitions(*group, *order)
    names = [*keys, "window_start", "window_end", *[c.split()[0] for c in output.split(", ")]]

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        *key, start = key
        out = [(*key, start, start + size, *row) for row in function(tuple(key), int(start), int(start) + size, (b[columns] for b in batches))]
        if out:
            yield pd.DataFrame(out, columns=names)

    schema = f"{_key_schema(df, keys)}window_start bigint, window_end bigint, {output}"
    return rows.groupBy(*group).applyInPandas(run, schema)
