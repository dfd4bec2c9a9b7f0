"""Benchmark decontamination: CGK embedding and bit-sampling LSH over item-sized windows.

Texts are compared as words: A-Z lowered, ASCII punctuation removed. A document is contaminated by an
item of n words when some run of its words is within ``k = floor(max_edits * n)`` word edits of the item.

1. Of any r words of the item at most k are missing from such a run. The r = ``anchors`` * n words of an
   item that fewest items have are its anchors; windows of n words with fewer than r - k anchors of the
   items of n words are passed over. This loses nothing.
2. The other windows and the items go through the same random walks (CGK): at step j the walk writes
   the current word and moves on if a random bit of (j, word) says so. Equal words bring two walks back
   together, so few edits make few differing places. Samples of places are hashed, and a window meets
   the items that share a bucket in one of the tables; their number follows from ``target_recall``.
3. Every candidate is verified exactly by the edit distance of the item to the best run of words around
   the window, so nothing is reported that is not within k edits.

The items are a stated query set: they go to the tasks in blocks of ``BLOCK``, each block a pass over
the documents. Documents are never shuffled.

Defined cases: a null or empty text has no hits; items that are null or have fewer than ``MIN_WORDS``
words are too short to tell and match nothing; repeated rows are reported or dropped each; an empty
table gives no rows; other columns are ignored by ``find_leaks`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import Words, batches, mix, table, trim_memory, trimmed
from tidemark.llm.queries import add

MIN_WORDS = 5
BLOCK = 20_000
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_HITS = "doc_id bigint, item_id bigint, distance int, n_words int"


@dataclass(frozen=True)
class Settings:
    """``agreement``: share of places in which embeddings of texts within ``max_edits`` agree, at least;
    ``places``: sampled per table; ``walks``: independent embeddings, dealt out to the tables."""

    max_edits: float = 0.25
    target_recall: float = 0.99
    agreement: float = 0.4
    places: int = 3
    walks: int = 4
    anchors: float = 0.4

    @property
    def tables(self) -> int:
        return math.ceil(math.log(1 - self.target_recall) / math.log(1 - self.agreement**self.places))


def embed(words: np.ndarray, sizes: np.ndarray, walk: int) -> np.ndarray:
    """CGK embedding of word sequences (a row each, ``sizes`` words, 0 behind them): 3 places a word."""
    rows, width = words.shape
    padded = np.concatenate((words, np.zeros((rows, 1), np.uint64)), axis=1)
    out, at, row = np.empty((rows, 3 * width), dtype=np.uint64), np.zeros(rows, dtype=np.int64), np.arange(rows)
    steps = mix(np.arange(1, 3 * width + 1, dtype=np.uint64) + np.uint64(walk * 100_003))
    for j in range(3 * width):
        out[:, j] = padded[row, at]
        bit = mix(out[:, j] ^ steps[j]) & np.uint64(1)
        at = np.minimum(at + bit.astype(np.int64), sizes)
    return out


def edits_within(item: list, text: list) -> int:
    """Least number of word edits between ``item`` and any run of words of ``text`` (bit-parallel)."""
    n = len(item)
    masks: dict = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    every, high = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = every, 0, n
    best = n
    for w in text:
        eq = masks.get(w, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | x
        up, down = (minus | ~(d | plus)) & every, plus & d
        score += 1 if up & high else -1 if down & high else 0
        best = min(best, score)
        up, down = up << 1 & every, down << 1 & every  # an alignment may start anywhere
        plus, minus = (down | ~(x | up)) & every, up & x
    return best


class Leaks:
    """The index over a block of items."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.settings, self.items, by_length = settings, [], {}
        for number, text in items:
            words = _words([text])
            if len(words.hash) >= MIN_WORDS:
                by_length.setdefault(len(words.hash), []).append(len(self.items))
                self.items.append((number, words.hash))
        every = [w for _, w in self.items] or [np.empty(0, np.uint64)]
        self.vocabulary, items_with = np.unique(np.concatenate([np.unique(w) for w in every]), return_counts=True)
        self.lengths = {}
        for n, members in by_length.items():
            matrix = np.stack([self.items[m][1] for m in members])
            place = np.searchsorted(self.vocabulary, matrix)
            r = max(self.allowed(n) + 1, math.ceil(settings.anchors * n))
            rarest = np.argsort(items_with[place], axis=1, kind="stable")[:, :r]
            anchor = np.zeros(len(self.vocabulary), dtype=bool)
            anchor[np.take_along_axis(place, rarest, axis=1)] = True
            self.lengths[n] = (members, anchor, r - self.allowed(n))
        keys = self._keys([w for _, w in self.items])
        self.order = np.argsort(keys, axis=0, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=0)

    def _keys(self, rows: list[np.ndarray]) -> np.ndarray:
        """A bucket for every word sequence and table. Sequences of one length sample the same places."""
        sizes = np.array([len(w) for w in rows], dtype=np.int64)
        matrix = np.zeros((len(rows), max(sizes, default=1)), dtype=np.uint64)
        for i, w in enumerate(rows):
            matrix[i, : len(w)] = w
        tables, walks = self.settings.tables, self.settings.walks
        lengths, of = np.unique(sizes, return_inverse=True)
        shape = (tables, self.settings.places)
        picks = np.stack([np.random.default_rng(n).integers(0, 3 * n, size=shape) for n in lengths]) if len(lengths) else np.zeros((0, *shape), int)
        keys = np.repeat(mix(sizes.astype(np.uint64))[:, None], tables, axis=1)
        for walk in range(walks):
            embedded = embed(matrix, sizes, walk)
            mine = np.arange(walk, tables, walks)
            for p in range(self.settings.places):
                keys[:, mine] = mix(keys[:, mine] ^ np.take_along_axis(embedded, picks[of][:, mine, p], axis=1))
        return keys

    def allowed(self, n: int) -> int:
        return int(self.settings.max_edits * n)

    def find(self, texts: list) -> list[tuple[int, int, int]]:
        """(text number, item number, edits) of every hit, least edits per pair."""
        hits: dict[tuple[int, int], int] = {}

        def hit(found: Iterator[tuple[int, int, int]]) -> None:
            for t, m, d in found:
                hits[t, m] = min(d, hits.get((t, m), d))

        waiting: list[tuple] = []
        for a, b in batches(texts) if self.items else ():
            words = _words(texts[a:b])
            hit((a + t, m, d) for t, m, d in self._short(words))
            for window in self._windows(words):
                waiting.append((a + window[0], *window[1:]))
                if len(waiting) == 8192:
                    hit(self._verify(waiting))
                    waiting = []
        hit(self._verify(waiting))
        return [(t, m, d) for (t, m), d in hits.items()]

    def _windows(self, words: Words) -> Iterator[tuple]:
        """(text, start, words of the window, words around it) of every window with enough anchors."""
        if not len(words.hash):
            return
        place = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        at = np.flatnonzero(self.vocabulary[place] == words.hash)
        place, owner = place[at], words.owner()
        for n, (_, anchor, need) in self.lengths.items():
            held = at[anchor[place]]
            first, last = held[: max(0, len(held) - need + 1)], held[need - 1 :]
            close = (last - first < n) & (owner[first] == owner[last])
            first, last, text = first[close], last[close], owner[first[close]]
            # every window of n words over these anchors that lies in the text
            low, high = np.maximum(last - n + 1, words.first[text]), np.minimum(first, words.first[text + 1] - n)
            count = np.maximum(high - low + 1, 0)
            starts = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            k = self.allowed(n)
            for start in np.unique(starts).tolist():
                t = int(owner[start])
                a, b = max(words.first[t], start - 2 * k), min(words.first[t + 1], start + n + 3 * k + 8)
                yield t, start, words.hash[start : start + n], words.hash[a:b]

    def _short(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """Texts a little shorter than an item hold no window of its size: verified directly."""
        size = np.diff(words.first)
        for n, (members, _, _) in self.lengths.items():
            for t in np.flatnonzero((size < n) & (size >= n - self.allowed(n))):
                text = words.hash[words.first[t] : words.first[t + 1]]
                for m in members:
                    number, item = self.items[m]
                    if np.isin(item, text).sum() >= n - self.allowed(n):
                        d = edits_within(item.tolist(), text.tolist())
                        if d <= self.allowed(n):
                            yield int(t), number, d

    def _verify(self, windows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        if not windows:
            return
        found, pairs = self._keys([w[2] for w in windows]), set()
        for t in range(found.shape[1]):
            low, high = np.searchsorted(self.keys[:, t], found[:, t], "left"), np.searchsorted(self.keys[:, t], found[:, t], "right")
            for w in np.flatnonzero(high > low).tolist():
                pairs.update((m, w) for m in self.order[low[w] : high[w], t].tolist())
        seen: dict[tuple[int, int], int] = {}
        for m, w in sorted(pairs, key=lambda p: (p[0], windows[p[1]][:2])):
            text, start, window, around = windows[w]
            number, item = self.items[m]
            if len(item) != len(window) or seen.get((text, m), -1) >= start:  # compared already
                continue
            k = self.allowed(len(item))
            seen[text, m] = start + k + 8
            d = edits_within(item.tolist(), around.tolist())
            if d <= k:
                yield text, number, d


def _words(texts: list) -> Words:
    """Words without ASCII punctuation."""
    return Words([None if t is None else t.encode("utf-8", "surrogatepass").translate(None, _PUNCTUATION).decode("utf-8", "surrogatepass") for t in texts])


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).filter("text IS NOT NULL")
    each = ((r[0], r[1]) for r in rows.orderBy("item_id", "text").toLocalIterator())
    while block := list(islice(each, BLOCK)):
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, item_id, distance, n_words)`` of every contaminated document and item of it."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def one(block: list[tuple[int, str]]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            leaks = Leaks(shared.value, settings)
            sizes = {number: len(w) for number, w in leaks.items}
            for part in parts:
                hits = leaks.find(part["text"].tolist())
                t = [h[0] for h in hits]
                numbers = part["doc_id"].astype("Int64").array[t]
                items = pd.array([h[1] for h in hits], dtype="Int64")
                yield pd.DataFrame({"doc_id": numbers, "item_id": items, "distance": [h[2] for h in hits], "n_words": [sizes[h[1]] for h in hits]})

        return rows.mapInPandas(trimmed(scan), _HITS)

    found = [one(block) for block in _blocks(benchmark)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], _HITS)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that no item contaminates."""
    out = docs
    for block in _blocks(benchmark):
        clean = _clean(docs.sparkSession.sparkContext.broadcast(block), settings)
        out = out.filter(F.pandas_udf(clean, "boolean")(F.col("text").cast("string")))
    return out


def _clean(shared, settings: Settings):
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        leaks = Leaks(shared.value, settings)
        for part in parts:
            keep = np.ones(len(part), dtype=bool)
            keep[[h[0] for h in leaks.find(part.tolist())]] = False
            yield pd.Series(keep)
        del leaks
        trim_memory()

    return clean


def _op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, or nearly, with the least number of word edits."""
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


add("op9_decontaminate", _op9)
