"""Where rows go: replication, shuffling, round robin, hashing, explicit placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.rows import replicate


def to_every(df: DataFrame, p: int) -> DataFrame:
    """Each row once for each of ``p`` receivers, numbered in ``copy``; nothing is shuffled."""
    return replicate(df, F.lit(p))


def shuffle(df: DataFrame, p: int, row_id: str, seed: int = 0) -> DataFrame:
    """Pseudo-random placement that a retried task reproduces (a hash of the row id, not rand())."""
    return df.repartition(p, F.xxhash64(F.col(row_id), F.lit(seed)))


def rebalance(df: DataFrame, p: int) -> DataFrame:
    """Round robin over ``p`` partitions."""
    return df.repartition(p)


def rescale(df: DataFrame, p: int) -> DataFrame:
    """To ``p`` partitions: merged without a shuffle when there are more, dealt out when fewer."""
    return df.coalesce(p) if p <= df.rdd.getNumPartitions() else df.repartition(p)


def by_key(df: DataFrame, p: int, *keys: str, split_hot: bool = False) -> DataFrame:
    """Rows of a key together. ``split_hot`` lets adaptive execution cut oversized partitions,
    for consumers (a write, a map) that do not need a hot key in one place."""
    return df.hint("rebalance", p, *[F.col(k) for k in keys]) if split_hot else df.repartition(p, *keys)


def to_subtask(df: DataFrame, p: int, subtask: Column) -> DataFrame:
    """Row to the partition whose number ``subtask`` gives."""
    return df.withColumn("subtask", subtask).repartitionById(p, F.col("subtask").cast("int"))


def spread(df: DataFrame) -> DataFrame:
    """An input that arrives in fewer partitions than there are cores (one large file with one row
    group) dealt out to all of them, ahead of work that multiplies rows. Otherwise unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
