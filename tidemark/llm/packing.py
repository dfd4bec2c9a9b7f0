"""Mixture-controlled packing: deficit round robin over source queues, in closed form.

Every source is a queue of tokens (its documents one after another). Round k credits queue s with
``length * weight_s`` tokens; the queue sends whole quanta while its credit lasts and carries the rest,
its deficit, into the next round. So after k rounds it has sent ``floor(k * weight_s * length /
quantum)`` quanta, or all it has: a formula in k, with no simulation and no order of execution. A
task finds the place of any quantum by itself, and deficits carry across windows and partitions
because the formula knows nothing of either. What the queues send is cut into windows of ``length``
tokens; all are full but the very last one. At any point a queue is within one quantum of its share,
until a queue is empty and the others go on in their proportions.

The default target is every queue's share of all tokens, the only one that a single pass over the
whole corpus can keep up to the end. The ``max_queues - 1`` largest sources and all with a target of their own have
a queue each; others, if there are more, share the last one.

Ids are written once to a scratch table; only counts (a row per partition and source) are shuffled.

Defined cases: a null text is empty and has only its end token; a null source is a source of its own;
repeated rows are packed once each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import join_small, table, trim_memory
from tidemark.llm.encode import KEEPS_SPACE, Encoder
from tidemark.llm.queries import add
from tidemark.session import new_scratch

_UNIT = 1 << 20  # weights are fractions of it
_PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class Schedule:
    """Where the tokens of the queues go: ``totals`` and ``weights`` (fractions of _UNIT) by queue."""

    def __init__(self, totals: list[int], weights: list[int], length: int, quantum: int):
        self.totals, self.weights = np.array(totals, dtype=np.int64), np.array(weights, dtype=np.int64)
        self.length, self.quantum = length, quantum
        # quanta after k rounds: floor(k * weight * up / down), with products kept under 2^63 by division first
        shared = gcd(length, _UNIT * quantum)
        self.up, self.down = length // shared, _UNIT * quantum // shared

    def sent(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens that each queue has sent after so many rounds: a row per entry, a column per queue."""
        whole, rest = np.divmod(rounds[:, None], self.down)
        rate = self.weights[None, :] * self.up
        return np.minimum((whole * rate + rest * rate // self.down) * self.quantum, self.totals[None, :])

    def _round_of(self, queue: np.ndarray, quantum: np.ndarray) -> np.ndarray:
        """The round that sends a queue's quantum: the first k with floor(k * rate / down) > quantum."""
        rate = self.weights[queue] * self.up
        whole, rest = np.divmod(quantum + 1, rate)
        return whole * self.down + -(-rest * self.down // rate)

    def place(self, queue: np.ndarray, quantum: np.ndarray) -> np.ndarray:
        """Position in the joint stream of the first token of a queue's quantum."""
        out = np.empty(len(queue), dtype=np.int64)
        step = max(1, (1 << 21) // max(1, len(self.totals)))
        for a in range(0, len(queue), step):
            q, j = queue[a : a + step], quantum[a : a + step]
            rounds = self._round_of(q, j)
            before, after = self.sent(rounds - 1), self.sent(rounds)
            earlier = np.arange(len(self.totals))[None, :] < q[:, None]
            row = np.arange(len(q))
            out[a : a + step] = np.where(earlier, after, before).sum(axis=1) + j * self.quantum - before[row, q]
        return out

    def pieces(self, queue: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cut token ranges of queues: (range number, start inside, length, joint position)."""
        first, last = start // self.quantum, (start + n - 1) // self.quantum
        count = last - first + 1
        owner = np.repeat(np.arange(len(n)), count)
        j = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        a = np.maximum(j * self.quantum, start[owner])
        b = np.minimum((j + 1) * self.quantum, (start + n)[owner])
        at = self.place(queue[owner], j) + a - j * self.quantum
        owner, inside, size, at = self._cut(owner, a - start[owner], b - a, at)
        # adjacent pieces that stay adjacent in one window are one piece
        joins = (owner[1:] == owner[:-1]) & (at[1:] == at[:-1] + size[:-1]) & (at[1:] // self.length == at[:-1] // self.length)
        heads = np.flatnonzero(np.concatenate(([True], ~joins)))
        return owner[heads], inside[heads], np.add.reduceat(size, heads), at[heads]

    def _cut(self, owner, inside, size, at):
        """Cut at the ends of windows; a quantum is no longer than a window, so once at most."""
        over = np.maximum(0, at % self.length + size - self.length)
        cut = np.flatnonzero(over)
        size = size - over
        owner = np.insert(owner, cut + 1, owner[cut])
        inside, at = np.insert(inside, cut + 1, (inside + size)[cut]), np.insert(at, cut + 1, (at + size)[cut])
        return owner, inside, np.insert(size, cut + 1, over[cut]), at


def _encoded(docs: DataFrame, tokenizer: str, end: int, cut: str) -> DataFrame:
    """Ids of every document with its place among those of its source and partition."""

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trim_memory()
        encoder, before, number = Encoder.of(tokenizer, cut), {}, TaskContext.get().partitionId()
        for part in parts:
            found = encoder.encode(part.pop("text").tolist(), end)
            n = [len(x) // np.dtype(encoder.dtype).itemsize for x in found]
            starts = []
            for source, size in zip(part["source"], n):
                starts.append(before.get(source, 0))
                before[source] = starts[-1] + size
            yield part.assign(part=number, start=starts, n=n, wide=encoder.dtype == "<u4", ids=found)
            del found
        trim_memory()

    named = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), named.alias("source"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, source string, part int, start bigint, n bigint, wide boolean, ids binary"
    path = new_scratch(docs.sparkSession, "encoded")
    rows.mapInPandas(encode, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    cut: str = KEEPS_SPACE,
    length: int = 1024,
    quantum: int = 256,
    targets: dict[str | None, float] | None = None,
    max_queues: int = 4096,
) -> DataFrame:
    """Pieces of all documents with their sequence and offset; ids as little-endian uint32.

    ``targets`` gives the wanted share of every source (missing ones: their share of all tokens)."""
    encoded = _encoded(docs, tokenizer, end, cut)
    sums = encoded.groupBy("part", "source").agg(F.sum("n").alias("n"))
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    total = by_source.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted = {"null" if source is None else f"={source}": share for source, share in (targets or {}).items()}
    chosen = by_source.filter(F.col("source").isin(*wanted)).collect() if wanted else []
    largest = by_source.filter(~F.col("source").isin(*wanted)) if wanted else by_source
    chosen += largest.orderBy(F.desc("n"), "source").limit(max(0, max_queues - 1 - len(chosen))).collect()
    chosen.sort(key=lambda r: (-r["n"], r["source"]))
    names, totals = [r["source"] for r in chosen] + [None], [r["n"] for r in chosen]
    totals.append(total - sum(totals))
    shares = [wanted.get(name, n / max(1, total)) for name, n in zip(names, totals)]
    weights = [max(1, round(_UNIT * s / (sum(shares) or 1))) for s in shares]
    schedule = Schedule(totals, weights, length, quantum)

    numbers = docs.sparkSession.createDataFrame(list(zip(names[:-1], range(len(names)))), "source string, queue int")
    queue = F.coalesce("queue", F.lit(len(names) - 1)).alias("queue")
    placed = sums.join(F.broadcast(numbers), "source", "left").select("part", "source", "n", queue)  # max_queues rows
    earlier = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.select(
        "part", "source", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Encoder.forget()
        trim_memory()
        for part in parts:
            if len(part):
                yield _placed(schedule, part)
        trim_memory()

    return join_small(encoded, bases, ["part", "source"]).mapInPandas(place, _PIECES)


def _placed(schedule: Schedule, part: pd.DataFrame) -> pd.DataFrame:
    n, base = part["n"].to_numpy(np.int64), (part["base"] + part["start"]).to_numpy(np.int64)
    owner, inside, size, at = schedule.pieces(part["queue"].to_numpy(np.int64), base, n)
    wide = part["wide"].tolist()
    ids = [np.frombuffer(x, dtype="<u4" if w else "<u2").astype("<u4").tobytes() for x, w in zip(part["ids"], wide)]
    cut = [ids[o][4 * a : 4 * (a + s)] for o, a, s in zip(owner.tolist(), inside.tolist(), size.tolist())]
    return pd.DataFrame({
        "doc_id": part["doc_id"].astype("Int64").array[owner], "start": inside, "length": size, "ids": cut,
        "doc_tokens": n[owner], "sequence_id": at // schedule.length, "offset": at % schedule.length,
    })


def sequences(pieces: DataFrame, length: int = 1024, pad: int = 0) -> DataFrame:
    """Whole sequences: ``(sequence_id, ids, n_tokens)``, padded to ``length`` unless the number of
    tokens is a power of two. A sequence has ``length`` tokens at most, so a group is bounded."""
    joined = pieces.groupBy("sequence_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("h")))), lambda p: p["h"]), "").alias("h")
    )
    n = (F.length("h") / 8).cast("int")
    power = n.bitwiseAND(n - 1) == 0
    padding = F.repeat(F.hex(F.lit(np.array([pad], dtype="<u4").tobytes())), F.when(power, 0).otherwise(F.lit(length) - n))
    return joined.select("sequence_id", F.unhex(F.concat("h", padding)).alias("ids"), n.alias("n_tokens"))


def pieces_of(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Pieces of ``docs`` under the production parameters, with a checksum in place of the ids."""
    import public_tokenizers

    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _op4(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    return pieces_of(spark, table(spark, folder, "documents"))


add("op4_pack_mixture", _op4)
