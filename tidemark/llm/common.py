"""Helpers shared by the operators: tables, scratch tables, size-checked joins, hashing of words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import storage
from tidemark.session import new_scratch

# A side of a join is broadcast up to this many rows (of a few numbers each); beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back, so that it is computed once and a
    lost executor costs a read of that table and nothing else."""
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def finished(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing will read again."""
    for df in tables:
        if path := getattr(df, "scratch", None):
            storage.delete(df.sparkSession, path)


def trim_memory() -> None:
    """Give memory that earlier tasks of this Python worker have freed back to the machine, and the table of powers, which
    is soon made again: workers are used again, and the allocators would keep it."""
    _POW[:] = [_powers(_MULT, 2), _powers(pow(_MULT, -1, 1 << 64), 2)]
    gc.collect()
    release_memory()


def release_memory() -> None:
    """The same for what is freed already, between two groups of a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the C library of GNU
        pass


def trimmed(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The work of a task on its batches, with freed memory given back before it and behind it: an idle worker holds none."""

    def run(parts: Iterator) -> Iterator:
        trim_memory()
        yield from work(parts)
        trim_memory()

    return run


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a ``right`` of narrow rows: broadcast while its counted rows are at most
    BROADCAST_ROWS, a shuffled join beyond. ``right`` should be cheap to evaluate twice."""
    small = right.count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right, on, how)


def numbered(df: DataFrame, by: list, label: str) -> DataFrame:
    """``df`` stored with a number ``id`` from 0 in the order ``by``: partitions by range, numbered inside, and
    the sizes of earlier partitions added. What the driver sees is a row per partition."""
    shift = 1 << 33
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(ordered.withColumn("at", F.monotonically_increasing_id()), label)
    part = F.expr(f"at div {shift}").cast("bigint")
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    before = np.concatenate(([0], np.cumsum([r["count"] for r in sizes])))[:-1].tolist()
    bases = df.sparkSession.createDataFrame([(r["part"], b) for r, b in zip(sizes, before)], "part bigint, base bigint")
    numbered = placed.withColumn("part", part).join(F.broadcast(bases), "part")
    return numbered.withColumn("id", F.col("at") - F.col("part") * shift + F.col("base")).drop("part", "at", "base")


# ---------------------------------------------------------------- words of many texts at once

_MULT = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2^64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POW: list[np.ndarray] = [_powers(_MULT, 2), _powers(pow(_MULT, -1, 1 << 64), 2)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, 1 << 20)
        _POW[0], _POW[1] = _powers(_MULT, size), _powers(pow(_MULT, -1, 1 << 64), size)
    return _POW


class Words:
    """All words of a list of texts (null: empty) as flat arrays.

    A word is a run of bytes other than the six ASCII spaces, A-Z lowered. ``raw`` holds the lowered
    bytes of all texts with a space between them; word i is ``raw[start[i]:end[i]]``, ``hash[i]`` its
    64-bit hash; text k has the words ``first[k]:first[k + 1]``. ``gaps`` tells by byte what stands
    between words, if not the spaces.
    """

    def __init__(self, texts, lower: bool = True, gaps: np.ndarray = _SPACE):
        encoded = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        raw = np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)
        self.raw = _LOWER[raw] if lower else raw
        space = gaps[raw]
        edge = np.diff(np.concatenate(([True], space)).view(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.first = np.searchsorted(self.start, self.text_start)
        if len(self.start):
            up, down = _power_tables(len(raw) + 1)
            summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[self.raw] * up[: len(raw)], dtype=np.uint64)))
            self.hash = mix((summed[self.end] - summed[self.start]) * down[self.start])
        else:
            self.hash = np.empty(0, dtype=np.uint64)

    def owner(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]].tobytes()


def batches(texts: list, limit: int = 1 << 20):
    """Cut positions into runs of at most ``limit`` characters (one longer text alone), so that the
    flat arrays of a run stay a fixed multiple of ``limit``."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > begin and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)
