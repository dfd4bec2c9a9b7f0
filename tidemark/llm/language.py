"""Language identification by prediction by partial matching (PPM).

Per language a tree of byte contexts up to ``ORDER`` bytes is counted over a training sample and then
frozen. A byte is coded in its longest known context: with count c of n and q different successors
(method C), it costs -log2(c / (n + q)) bits if it was seen there; otherwise an escape costs
-log2(q / (n + q)) and the next shorter context tries, down to all 256 bytes alike. A text's code
length in a language is the exact sum over its bytes, lower-cased; contexts start anew at white
space, so that a word costs the same wherever it stands and every different word of a batch is coded
once. The language with the least code length is predicted.

All trees are one set of sorted arrays: for a context and byte seen in any language, the full cost in
every language (escapes included); for contexts, the cost of escaping. So a batch of bytes is coded
with a binary search per order.

Defined cases: texts that are null or hold no letter are ``und`` with score 0; ties go to the language
that sorts first; without training rows everything is ``und``; repeated rows are predicted each; an
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import Words, batches, join_small, table, trim_memory
from tidemark.llm.queries import add

ORDER = 4
# The training sample: so many rows of every language, in expectation, chosen by a hash of the id.
SAMPLE_ROWS = 600
BLOCK = 64  # languages that share arrays
UNKNOWN = "und"


def _grams(raw: np.ndarray, start: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` bytes before every byte and the byte itself as one number; places where the
    context would reach over the word's start have bytes of value 0 (a word holds none, but if it
    does it only shares a context with a shorter one)."""
    since = np.arange(len(raw)) - start
    out = raw.astype(np.uint64) + np.uint64(1)
    for back in range(1, order + 1):
        if back < len(raw):
            shifted = np.zeros(len(raw), dtype=np.uint64)
            shifted[back:] = raw[:-back].astype(np.uint64) + np.uint64(1)
            out |= np.where(since >= back, shifted, np.uint64(0)) << np.uint64(9 * back)
    return out


class Model:
    """Frozen trees of all languages."""

    def __init__(self, languages: list[str], samples: list[list[str]], order: int = ORDER):
        self.languages, self.order = languages, order
        n = len(languages)
        floor = np.full((1, n), 8.0)  # below every context: 256 bytes alike
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []  # per order: context and byte -> cost
        self.escapes: list[tuple[np.ndarray, np.ndarray]] = []  # per order: context -> cost of escaping
        texts = [_Coded(s) for s in samples]
        for k in range(order + 1 if texts else 0):
            grams = [np.unique(_grams(t.raw, t.start, k), return_counts=True) for t in texts]
            every = np.unique(np.concatenate([g for g, _ in grams]))
            contexts = np.unique(every >> np.uint64(9))
            cost = np.empty((len(every), n), dtype=np.float32)
            escape = np.zeros((len(contexts), n), dtype=np.float32)
            lower = self._cost(every, k - 1) if k else np.repeat(floor, len(every), axis=0)
            of = np.searchsorted(contexts, every >> np.uint64(9))
            for i, (g, c) in enumerate(grams):
                at = np.searchsorted(contexts, g >> np.uint64(9))
                total = np.bincount(at, weights=c, minlength=len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                known = kinds > 0
                escape[known, i] = -np.log2(kinds[known] / (total[known] + kinds[known]))
                cost[:, i] = escape[of, i] + lower[:, i]
                place = np.searchsorted(every, g)
                cost[place, i] = -np.log2(c / (total[at] + kinds[at]))
            self.seen.append((every, cost))
            self.escapes.append((contexts, escape))

    def _cost(self, grams: np.ndarray, k: int) -> np.ndarray:
        """Cost of the last byte of every gram in its longest context of at most k bytes: a row each."""
        mask = np.uint64((1 << 9 * (k + 1)) - 1)
        out = np.zeros((len(grams), len(self.languages)), dtype=np.float32)
        rest, left = np.arange(len(grams)), grams & mask
        for order in range(k, -1, -1):
            keys, cost = self.seen[order]
            cut = left & np.uint64((1 << 9 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(keys, cut), len(keys) - 1) if len(keys) else np.zeros(len(cut), dtype=int)
            hit = keys[at] == cut if len(keys) else np.zeros(len(cut), dtype=bool)
            out[rest[hit]] += cost[at[hit]]
            rest, left, cut = rest[~hit], left[~hit], cut[~hit]
            if not len(rest):
                return out
            contexts, escape = self.escapes[order]
            at = np.minimum(np.searchsorted(contexts, cut >> np.uint64(9)), len(contexts) - 1)
            known = contexts[at] == cut >> np.uint64(9)
            out[rest[known]] += escape[at[known]]
        out[rest] += 8.0
        return out

    def lengths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code length in bits of every text in every language, and its number of bytes."""
        words = Words(texts)
        bits = np.zeros((len(texts), len(self.languages)))
        if not len(words.hash):
            return bits, np.zeros(len(texts), dtype=np.int64)
        kinds, first, kind = np.unique(words.hash, return_index=True, return_inverse=True)
        size = (words.end - words.start)[first]
        ends = np.cumsum(size)
        index = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(words.start[first], size)
        cost = np.empty((len(kinds), len(self.languages)))
        raw, begin = words.raw[index], np.repeat(ends - size, size)
        grams = _grams(raw, begin, self.order)
        step, low = 1 << 18, 0
        while low < len(kinds):  # in runs of whole words of about ``step`` bytes
            base = ends[low] - size[low]
            high = max(low + 1, int(np.searchsorted(ends, base + step, "right")))
            part = self._cost(grams[base : ends[high - 1]], self.order)
            cost[low:high] = np.add.reduceat(part.astype(np.float64), (ends - size)[low:high] - base, axis=0)
            low = high
        owner = words.owner()
        for i in range(len(self.languages)):
            bits[:, i] = np.bincount(owner, weights=cost[kind, i], minlength=len(texts))
        return bits, np.bincount(owner, weights=size[kind], minlength=len(texts)).astype(np.int64)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """Language, score (probability under equal priors) and bits per byte of every text."""
        n = len(texts)
        lang, score, rate = np.full(n, UNKNOWN, dtype=object), np.zeros(n), np.zeros(n)
        if self.languages:
            for a, b in batches(texts, 2 << 20):
                part = [_lower(t) for t in texts[a:b]]
                bits, size = self.lengths(part)
                best = bits.argmin(axis=1)
                lead = np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0))
                letters = np.array([any(map(str.isalpha, t)) for t in part], dtype=bool)
                lang[a:b][letters] = np.array(self.languages, dtype=object)[best[letters]]
                score[a:b] = np.where(letters, 1 / lead.sum(axis=1), 0)
                rate[a:b] = np.where(letters, bits.min(axis=1) / np.maximum(size, 1), 0)
        return pd.DataFrame({"lang": lang, "score": score, "bits": rate})


class Models(Model):
    """Models of any number of languages, BLOCK at a time, so that an array has BLOCK columns at most. A
    code length depends on its own language only, so it is the same in any block."""

    def __init__(self, languages: list[str], samples: list[list[str]], order: int = ORDER):
        self.languages, self.order = languages, order
        self.parts = [Model(languages[a : a + BLOCK], samples[a : a + BLOCK], order) for a in range(0, len(languages), BLOCK)]

    def lengths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [m.lengths(texts) for m in self.parts]
        return np.concatenate([bits for bits, _ in found], axis=1), found[0][1]


def _lower(text: str | None) -> str:
    return "" if text is None else text.lower()


class _Coded:
    """The words of a sample as training bytes."""

    def __init__(self, texts: list[str]):
        words = Words([_lower(t) for t in texts])
        size = words.end - words.start
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        offset = np.repeat(ends - size, size)
        self.raw = words.raw[np.arange(total) - offset + np.repeat(words.start, size)] if total else np.empty(0, np.uint8)
        self.start = offset


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``labelled(doc_id, text, lang)``, null languages ignored.

    About ``sample_rows`` rows of every language are fetched, whatever the size of the table."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    unit = 1 << 30
    share = (F.least(F.lit(1.0), F.lit(float(sample_rows)) / F.count("*")) * unit).cast("bigint")
    shares = rows.groupBy("lang").agg(share.alias("share"))
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(unit)) < F.col("share")
    chosen = join_small(rows.select("doc_id", "text", "lang"), shares, ["lang"]).filter(drawn)
    found: dict[str, list[str]] = {}
    for r in chosen.select("lang", F.col("text").cast("string")).collect():
        found.setdefault(r[0], []).append(r[1])
    languages = sorted(found)
    return Models(languages, [found[x] for x in languages])


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a struct column ``_language(lang, score, bits)`` behind its own. To Spark the function is not deterministic,
    or it would push a filter on the column below it and predict twice, in twice as many Python workers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield shared.value.predict(part.tolist())
        trim_memory()

    udf = F.pandas_udf(predict, "lang string, score double, bits double").asNondeterministic()
    return docs.withColumn("_language", udf(F.col("text").cast("string")))


def _held_out(divisor: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string")) % divisor == remainder


def _op3(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every whole text; learned from the rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~_held_out(3, 1)))
    found = with_language(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(_held_out(3, 1), F.lit(False)).alias("held_out"),
        F.col("_language.lang").alias("lang_pred"),
        F.col("_language.score").alias("score"),
    )


add("op3_language_id", _op3)
