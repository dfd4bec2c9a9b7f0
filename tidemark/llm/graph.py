"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import finished, stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the smallest one it reaches through the given links."""
    nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = index[: len(a)], index[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        np.minimum.at(least, u, root[v])
        np.minimum.at(least, v, root[u])
        least = least[least]
        if (least == root).all():
            break
        root = least
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


LINKS_PER_TASK = 500_000


def thinned(links: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that reach the same nodes as the given ones: every task keeps those from its nodes to the
    smallest one that they reach there, fewer than it has nodes. ``links`` should be cheap to count."""
    tasks = -(-links.count() // LINKS_PER_TASK) or 1

    def thin(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [p.to_numpy(np.int64) for p in parts]
        rows = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        a, b = forest(rows[:, 0], rows[:, 1])
        yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return links.select("a", "b").repartition(tasks).mapInPandas(thin, "a bigint, b bigint")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node of ``links(a, b)``: the smallest node it can reach.

    Alternates two steps that keep components: every node ties its larger neighbours to its smallest
    neighbour, then its smaller ones. The links end as stars around the smallest nodes after about
    log(n) rounds. A node's neighbours are aggregated and joined, never gathered; each round is a
    table in the shared folder.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    links = stored(links, "links")
    before = _mark(links)
    for _ in range(max_rounds):
        if not before[0]:
            break
        older, links = links, stored(_small_star(_large_star(links)), "links")
        finished(older)
        now = _mark(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    larger = both.filter("b > a")
    return larger.join(least, larger["a"] == least["k"]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
    joined = links.join(least, links["a"] == least["k"])
    tied = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
    return tied.union(least.select(F.col("k"), F.col("m"))).toDF("a", "b").distinct()
