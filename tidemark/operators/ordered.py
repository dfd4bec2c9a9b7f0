"""Ordered work inside a key that stays parallel when one key holds most of the rows.

A window such as ``sum(x) over (partition by user order by ts)`` sends all rows of a user to one
task. Here a key with many rows is cut along the order into chunks of about ``target_rows`` rows:

1. ``cut`` counts the input, draws a bounded sample of (key, order) and places the cut points;
   keys that are not hot keep one chunk and take part in no further step;
2. the window runs per (key, chunk): one shuffle of the rows, hot keys spread over many tasks;
3. each chunk of a hot key is summarised (one row), the summaries are prefixed and broadcast back.

The sample only places cut points; no row is dropped and the answers do not depend on it.
Cut points, and therefore summaries, number at most ``max_chunks`` plus sampling noise: that is the
bound which allows both broadcasts.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.functions.sizing import is_small

CHUNK = "__chunk"
HOT = "__hot"
CUTS = "__cuts"
KEY_HASH = "__key_hash"

SAMPLES_PER_CHUNK = 16
TARGET_ROWS = 2_000_000
MAX_CHUNKS = 16_384


@dataclass
class Cut:
    """An input with a chunk number per row; ``split`` tells whether any key was cut."""

    rows: DataFrame
    keys: list[str]
    order: list[str]
    split: bool

    def window(self) -> Window:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*self.order)

    def hot_rows(self) -> DataFrame:
        return self.rows.filter(F.col(HOT)) if self.keys else self.rows


def _order_value(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _with_chunk(df: DataFrame, cuts: Column, value: Column, longest: int) -> DataFrame:
    """Add the number of cut points at or below ``value``: a binary search by halving steps, one
    projection per step, so that it stays in generated code and no step is evaluated twice."""
    df = df.withColumn(CHUNK, F.lit(0))
    for step in (1 << b for b in range(max(longest, 1).bit_length() - 1, -1, -1)):
        passed = F.get(cuts, F.col(CHUNK) + F.lit(step - 1)) <= value
        df = df.withColumn(CHUNK, F.col(CHUNK) + F.when(passed, step).otherwise(0))
    return df


def _cut_points(sample: list[tuple]) -> dict[int, list]:
    per_key: dict[int, list] = defaultdict(list)
    for key, *value in sample:
        if all(v is not None for v in value):
            per_key[key].append(tuple(value) if len(value) > 1 else value[0])
    cuts = {}
    for key, values in per_key.items():
        pieces = len(values) // SAMPLES_PER_CHUNK
        if pieces >= 2:
            values.sort()
            cuts[key] = sorted({values[i * len(values) // pieces] for i in range(1, pieces)})
    return cuts


def cut(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    target_rows: int | None = None,
    max_chunks: int = MAX_CHUNKS,
) -> Cut:
    """Number the chunks of ``df`` per key along ``order`` (ascending, unique within a key)."""
    spark = df.sparkSession
    whole = Cut(df.withColumn(CHUNK, F.lit(0)), keys, order, split=False)
    if keys and target_rows is None and is_small(df):
        return whole
    # The estimates above and below read only the columns they need.
    n = df.count()
    limit = target_rows or int(spark.conf.get("spark.tidemark.chunkRows", str(TARGET_ROWS)))
    if not keys:
        # A total order has no keys to spread over tasks: cut at least once per core.
        limit = min(limit, math.ceil(n / spark.sparkContext.defaultParallelism) or 1)
    limit = max(limit, math.ceil(n / max_chunks), 1)
    if n <= limit:
        return whole
    # Expected sample: SAMPLES_PER_CHUNK * n / limit <= SAMPLES_PER_CHUNK * max_chunks rows.
    fraction = min(1.0, SAMPLES_PER_CHUNK / limit)
    # Keys are sampled as hashes, so their width does not matter. Two keys with one hash would share
    # cut points, which is harmless: rows are still grouped by the keys themselves.
    key_hash = F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")
    sample = df.select(key_hash, *order).sample(fraction, seed=7).collect()
    cuts = _cut_points([tuple(r) for r in sample])
    if not cuts:
        return whole
    longest = max(len(c) for c in cuts.values())
    value = _order_value(order)
    order_type = df.select(value.alias("v")).schema["v"].dataType
    schema = T.StructType().add(KEY_HASH, T.LongType()).add(CUTS, T.ArrayType(order_type))
    table = spark.createDataFrame(list(cuts.items()), schema)
    if not keys:
        return Cut(_with_chunk(df, table.select(CUTS).scalar(), value, longest), keys, order, split=True)
    hot = df.withColumn(KEY_HASH, key_hash).join(F.broadcast(table), KEY_HASH, "left")
    rows = _with_chunk(hot.withColumn(HOT, F.col(CUTS).isNotNull()), F.col(CUTS), value, longest)
    return Cut(rows.drop(CUTS, KEY_HASH), keys, order, split=True)


def _attach(c: Cut, carry: DataFrame) -> DataFrame:
    """Give every row the carry of its chunk (rows of keys that were not cut get nulls)."""
    on = [*c.keys, CHUNK]
    renamed = carry.select(*[F.col(k).alias(f"__c_{k}") for k in on], *[x for x in carry.columns if x not in on])
    same = [c.rows[k].eqNullSafe(renamed[f"__c_{k}"]) for k in c.keys]
    same.append(c.rows[CHUNK] == renamed[f"__c_{CHUNK}"])
    return c.rows.join(F.broadcast(renamed), same, "left").drop(*[f"__c_{k}" for k in on])


def _done(df: DataFrame, *extra: str) -> DataFrame:
    return df.drop(CHUNK, HOT, *extra)


# kind -> (value inside the chunk, value of a whole chunk, fold over earlier chunks)
def _parts(kind: str, x: Column, order: Column):
    if kind == "count":
        return F.count(x), F.count(x), F.sum
    if kind == "sum":
        return F.sum(x), F.sum(x), F.sum
    if kind == "min":
        return F.min(x), F.min(x), F.min
    if kind == "max":
        return F.max(x), F.max(x), F.max
    if kind == "last":
        newest = F.max_by(x, F.when(x.isNotNull(), order))
        return F.last(x, ignorenulls=True), newest, lambda s: F.last(s, ignorenulls=True)
    raise ValueError(f"unknown running aggregate {kind!r}")


def _combine(kind: str, local: Column, carry: Column) -> Column:
    if kind == "count":
        return local + F.coalesce(carry, F.lit(0))
    if kind == "sum":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)
    if kind == "last":
        return F.coalesce(local, carry)
    return F.least(local, carry) if kind == "min" else F.greatest(local, carry)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    aggs: dict[str, tuple[str, Column]],
    before: bool = False,
    **cut_options,
) -> DataFrame:
    """Add running aggregates per key, one value per input row.

    ``aggs`` maps an output name to (kind, column) with kind one of count, sum, min, max, last
    (last = latest non-null). ``before=True`` leaves the current row out. ``keys=[]`` is a running
    aggregate over everything. Batch only.
    """
    c = cut(df, keys, order, **cut_options)
    end = -1 if before else Window.currentRow
    w = c.window().rowsBetween(Window.unboundedPreceding, end)
    value = _order_value(order)
    parts = {name: _parts(kind, x, value) for name, (kind, x) in aggs.items()}
    if not c.split:
        return _done(c.rows.withColumns({name: p[0].over(w) for name, p in parts.items()}))
    summary = c.hot_rows().groupBy(*keys, CHUNK).agg(*[p[1].alias(name) for name, p in parts.items()])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys, CHUNK, *[p[2](F.col(name)).over(earlier).alias(f"__carry_{name}") for name, p in parts.items()]
    )
    rows = _attach(c, carry)
    local = rows.withColumns({f"__local_{name}": p[0].over(w) for name, p in parts.items()})
    out = local.withColumns(
        {n: _combine(kind, F.col(f"__local_{n}"), F.col(f"__carry_{n}")) for n, (kind, _) in aggs.items()}
    )
    return _done(out, *[f"__{part}_{name}" for part in ("carry", "local") for name in parts])


def shifted(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    outputs: dict[str, tuple[str, int]],
    **cut_options,
) -> DataFrame:
    """Add values of neighbouring rows of the key: ``{out: (column, offset)}``.

    Offset -1 is the row before, +1 the row after. Batch only.
    """
    c = cut(df, keys, order, **cut_options)
    w = c.window()
    sources = sorted({column for column, _ in outputs.values()})
    item = F.struct(*sources)
    if not c.split:
        return _done(c.rows.withColumns({out: F.lag(col, -off).over(w) for out, (col, off) in outputs.items()}))
    back = max([-off for _, off in outputs.values()] + [0])
    ahead = max([off for _, off in outputs.values()] + [0])
    carry = None
    for name, reach, newest_first in (("__back", back, True), ("__ahead", ahead, False)):
        if reach:
            edge = _edge_rows(c, item, reach, newest_first, name)
            carry = edge if carry is None else carry.join(edge, [*keys, CHUNK])
    rows = _attach(c, carry)
    columns = {}
    for name, reach, sign in (("__back", back, -1), ("__ahead", ahead, 1)):
        near = [F.lag(item, -sign * j).over(w) for j in range(1, reach + 1)]
        for j in range(1, reach + 1):
            inside = sum((near[i].isNotNull().cast("int") for i in range(j - 1)), F.lit(0))
            columns[sign * j] = F.coalesce(near[j - 1], F.get(F.col(name), F.lit(j - 1) - inside))
    rows = rows.withColumns({out: columns[off].getField(col) for out, (col, off) in outputs.items()})
    return _done(rows, *[n for n, reach in (("__back", back), ("__ahead", ahead)) if reach])


def _edge_rows(c: Cut, item: Column, reach: int, newest_first: bool, name: str) -> DataFrame:
    """Per chunk, the ``reach`` rows nearest to it in the neighbouring chunks, nearest first."""
    toward = [F.col(o).desc() if newest_first else F.col(o).asc() for o in c.order]
    per_chunk = Window.partitionBy(*c.keys, CHUNK).orderBy(*toward)
    edge = (
        c.hot_rows()
        .select(*c.keys, CHUNK, F.struct(_order_value(c.order).alias("o"), item.alias("x")).alias("e"), *c.order)
        .withColumn("__n", F.row_number().over(per_chunk))
        .filter(F.col("__n") <= reach)
        .groupBy(*c.keys, CHUNK)
        .agg(F.collect_list("e").alias("edge"))  # at most ``reach`` rows
    )
    # Every chunk has a row, so ``reach`` neighbouring chunks hold the ``reach`` nearest rows.
    beside = Window.partitionBy(*c.keys).orderBy(F.col(CHUNK).asc() if newest_first else F.col(CHUNK).desc())
    near = F.flatten(F.collect_list("edge").over(beside.rowsBetween(-reach, -1)))
    nearest = F.slice(F.sort_array(near, asc=not newest_first), 1, reach)
    return edge.select(*c.keys, CHUNK, F.transform(nearest, lambda e: e["x"]).alias(name))
