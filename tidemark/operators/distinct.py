"""Distinct visitors per window: exact, from a mergeable sketch, and from a mergeable bit set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import interval
from tidemark.operators.windows import bounds


def uv_exact(df: DataFrame, size: int, who: str, ts: str = "ts") -> DataFrame:
    """Distinct ``who`` per window. The ids are made distinct before they are counted, which also
    is the only form a stream accepts."""
    seen = df.select(F.window(ts, interval(size)).alias("window"), who).dropDuplicates(["window", who])
    return seen.groupBy("window").agg(F.count(who).alias("uv")).select(*bounds(), "uv")


def _estimate(who: str, log2_size: int) -> Column:
    return F.hll_sketch_estimate(F.hll_sketch_agg(who, log2_size))


def uv_sketch(df: DataFrame, size: int, who: str, ts: str = "ts", log2_size: int = 14) -> DataFrame:
    """Approximate distinct ``who`` per window: one HyperLogLog sketch per window, of at most
    2^log2_size registers and sparse while there are few ids, merged from partial sketches.
    The relative standard error is about 1.04 / sqrt(2^log2_size)."""
    grouped = df.groupBy(F.window(ts, interval(size))).agg(_estimate(who, log2_size).alias("uv"))
    return grouped.select(*bounds(), "uv")


def uv_sketches(df: DataFrame, size: int, who: str, ts: str = "ts", log2_size: int = 14) -> DataFrame:
    """The sketches themselves, to be stored and merged later with ``hll_union_agg``."""
    grouped = df.groupBy(F.window(ts, interval(size))).agg(F.hll_sketch_agg(who, log2_size).alias("sketch"))
    return grouped.select(*bounds(), "sketch")


def uv_sketch_checked(df: DataFrame, size: int, who: str, ts: str = "ts", log2_size: int = 14) -> DataFrame:
    """Sketch of the raw rows and exact count side by side."""
    approx = uv_sketch(df, size, who, ts, log2_size).withColumnRenamed("uv", "approx")
    both = uv_exact(df, size, who, ts).join(approx, ["window_start", "window_end"])
    error = F.abs(F.col("approx") - F.col("uv"))
    return both.select("window_start", "window_end", "uv", (error <= F.col("uv") * F.lit(0.05)).alias("within_5pct"))


def bloom_bits(expected: int, error: float) -> int:
    """Bits of a set in which ``expected`` ids lose at most a share ``error`` to ids that came before: among n ids in
    m bits about n / (2 m) meet a bit that is set already."""
    return max(1, round(expected / (2 * error)))


def bloom_sets(df: DataFrame, keys: list[Column], who: str, expected: int = 100_000, error: float = 0.01) -> DataFrame:
    """Bit sets of ``who`` per key, in blocks of 32,768 bits: ``(keys, block, bits)``. Null ids are left out.

    An id sets one bit. Sets of parts of the input merge with ``bitmap_or_agg`` by key and block, so they can be kept and
    united later; Spark merges them the same way before and after the shuffle, whatever the number of rows."""
    place = F.pmod(F.xxhash64(who), F.lit(bloom_bits(expected, error))) + F.lit(1)
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    placed = df.filter(F.col(who).isNotNull()).select(*named, place.alias("__p"))
    group = [F.col(f"__k{i}") for i in range(len(keys))]
    blocks = placed.groupBy(*group, F.bitmap_bucket_number("__p").alias("block"))
    return blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("__p")).alias("bits"))


def bloom_count(sets: DataFrame, n_keys: int) -> DataFrame:
    """Ids that found their bit unset: never more than there are distinct ones. ``(__k0.., uv)``."""
    group = [f"__k{i}" for i in range(n_keys)]
    merged = sets.groupBy(*group, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*group).agg(F.sum(F.bitmap_count("bits")).alias("uv"))


def uv_bloom_checked(
    df: DataFrame, keys: list[Column], names: list[str], who: str, expected: int = 100_000, error: float = 0.01
) -> DataFrame:
    """Bit sets and exact count side by side: whether the set counts no more than there are, and not less than
    the ``error`` it was made for allows (half as much again for chance)."""
    approx = bloom_count(bloom_sets(df, keys, who, expected, error), len(keys)).withColumnRenamed("uv", "approx")
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    group = [f"__k{i}" for i in range(len(keys))]
    exact = df.select(*named, who).distinct().groupBy(*group).agg(F.count(who).alias("uv"))
    both = exact.join(approx, group)
    least = F.col("uv") - F.ceil(F.col("uv") * F.lit(1.5 * error)) - F.lit(3)
    return both.select(
        *[F.col(g).alias(n) for g, n in zip(group, names)], "uv",
        (F.col("approx") <= F.col("uv")).alias("never_over"), (F.col("approx") >= least).alias("within_error"),
    )
