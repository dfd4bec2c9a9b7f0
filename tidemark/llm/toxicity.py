"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Only confirmed toxic examples carry a label; everything else is unlabelled text, toxic texts included.
With the class prior p the risk of a linear classifier is estimated as
``p * R+(positive) + max(0, R-(unlabelled) - p * R-(positive))``; where the second part turns negative,
which only overfitting does, the step goes the other way.

Features are the presence of a word and of every run of five bytes in it (A-Z lowered). Kept are those
that enough positives have and that are toxic four times in five after the prior's correction,
``p * P(feature | positive) >= 0.8 * P(feature | unlabelled)``, the latter counted in the tasks over so many
rows that COUNTED_TOXIC toxic ones are expected (all, where the table has fewer); the classifier is trained on them in
numpy and scores whole texts in the tasks.

Defined cases: a null or empty text has no features and gets the base score; without positives every
score is 0; repeated rows are scored each (in the sample equal texts count once); an empty table gives
no rows; columns other than the id and the text are never read for a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import Words, batches, mix, table
from tidemark.llm.queries import add

# The bounded sample of the classifier: rows in expectation, chosen by a hash of the id.
SAMPLE_POSITIVE, SAMPLE_UNLABELLED = 2_500, 8_000
# Features are counted over so many unlabelled rows that this many toxic ones are expected among them.
COUNTED_TOXIC = 500
MAX_FEATURES = 1 << 15
RUN = 5
_UNIT = 1 << 30


def features(texts: list, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs; ``only`` (sorted) restricts the features."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in batches(texts):
        words = Words(texts[a:b])
        if not len(words.hash):
            continue
        kinds, first, kind = np.unique(words.hash, return_index=True, return_inverse=True)
        size = (words.end - words.start)[first]
        runs = np.maximum(size - RUN + 1, 0)
        owner = np.repeat(np.arange(len(kinds)), runs)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(words.start[first], runs)
        value = np.zeros(len(owner), dtype=np.uint64)
        for k in range(RUN):
            value = value << np.uint64(8) | words.raw[at + k].astype(np.uint64)
        word = np.concatenate((np.arange(len(kinds)), owner))
        feature = np.concatenate((kinds, mix(value + np.uint64(1 << 50))))
        if only is not None:
            place = np.minimum(np.searchsorted(only, feature), max(len(only) - 1, 0))
            keep = only[place] == feature if len(only) else np.zeros(len(feature), dtype=bool)
            word, feature = word[keep], place[keep].astype(np.uint64)
        order = np.argsort(word, kind="stable")
        word, feature = word[order], feature[order]
        count = np.bincount(word, minlength=len(kinds))
        begin = np.cumsum(count) - count
        text = words.owner()
        used = count[kind] > 0
        text, kind = text[used], kind[used]
        pair = np.unique(text.astype(np.int64) * len(kinds) + kind)  # each word once per text
        text, kind = pair // len(kinds), pair % len(kinds)
        n = count[kind]
        index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[kind], n)
        found.append((np.repeat(text, n) + a, feature[index]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    text, feature = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    return text[new], feature[new]


@dataclass
class Classifier:
    known: np.ndarray  # sorted hashes of the features
    weights: np.ndarray
    bias: float

    def score(self, texts: list) -> np.ndarray:
        text, feature = features(texts, self.known)
        total = np.bincount(text, weights=self.weights[feature.astype(np.int64)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -500, 500)))


def _presence(texts: list[str], known: np.ndarray) -> np.ndarray:
    """The number of texts that each feature is in."""
    return np.bincount(features(texts, known)[1].astype(np.int64), minlength=len(known))


def _log1p_exp(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def fit(
    positive: list[str], unlabelled: list[str], prior: float, steps: int = 300, rate: float = 0.05, decay: float = 1e-3,
    counted: Callable[[np.ndarray], tuple[np.ndarray, int]] | None = None,
) -> Classifier:
    """Minimise the non-negative risk with the logistic loss (Adam over the whole sample).

    ``counted`` gives in how many of how many unlabelled texts each feature is (default: of ``unlabelled``)."""
    n_p, n_u = len(positive), len(unlabelled)
    if not n_p or not n_u:
        return Classifier(np.empty(0, np.uint64), np.empty(0), -500.0)
    row_p, hash_p = features(positive)
    seen, count = np.unique(hash_p, return_counts=True)
    often = count >= max(5, 0.004 * n_p)
    seen, count = seen[often], count[often]
    in_u, n_all = counted(seen) if counted else (_presence(unlabelled, seen), n_u)
    telling = np.flatnonzero(prior * count / n_p >= 0.8 * (in_u + 1) / max(1, n_all))
    known = np.sort(seen[telling[np.argsort(-count[telling], kind="stable")][:MAX_FEATURES]])
    row_p, col_p = (x.astype(np.int64) for x in features(positive, known))
    row_u, col_u = (x.astype(np.int64) for x in features(unlabelled, known))
    w = np.zeros(len(known) + 1)  # the last one is the bias
    m, v = np.zeros_like(w), np.zeros_like(w)

    def logits(row: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(row, weights=w[col], minlength=n) + w[-1]

    def pulled(g: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(col, weights=g[row], minlength=len(known)), g.sum())

    for t in range(1, steps + 1):
        z_p, z_u = logits(row_p, col_p, n_p), logits(row_u, col_u, n_u)
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        negative = _log1p_exp(z_u).mean() - prior * _log1p_exp(z_p).mean()
        grad_negative = pulled(s_u / n_u, row_u, col_u) - prior * pulled(s_p / n_p, row_p, col_p)
        if negative >= 0:
            grad = prior * pulled((s_p - 1) / n_p, row_p, col_p) + grad_negative
        else:
            grad = -grad_negative
        grad[:-1] += decay * prior * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Classifier(known, w[:-1], float(w[-1]))


def _drawn(rows: DataFrame, wanted: float, salt: int) -> DataFrame:
    """Distinct texts of about ``wanted`` rows."""
    n = rows.count()
    share = int(min(1.0, wanted / max(1, n)) * _UNIT)
    chosen = rows.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(salt)), F.lit(_UNIT)) < share)
    return chosen.select(F.col("text").cast("string").alias("text")).distinct()


def _sampled(rows: DataFrame, wanted: int, salt: int) -> list[str]:
    return [r[0] for r in _drawn(rows, wanted, salt).collect()]


def _counted(texts: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of how many texts each feature is; only counts leave the tasks."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(shared.value), dtype=np.int64), 0
        for part in parts:
            total += _presence(part["text"].tolist(), shared.value)
            n += len(part)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(total[at], n)})

    rows = texts.mapInPandas(count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    numbers = np.zeros(len(known) + 1, dtype=np.int64)
    numbers[rows["feature"].to_numpy(np.int64)] = rows["n"]  # the last one is the number of texts
    return numbers[:-1], int(numbers[-1])


def train(docs: DataFrame, toxic_ids: DataFrame, prior: float) -> Classifier:
    """A classifier from the documents whose ids ``toxic_ids(doc_id)`` confirms and unlabelled ones."""
    texts = docs.filter("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text")
    positive = texts.join(toxic_ids.select("doc_id").distinct(), "doc_id", "left_semi")
    wide = max(SAMPLE_UNLABELLED, COUNTED_TOXIC / prior)
    return fit(
        _sampled(positive, SAMPLE_POSITIVE, 1), _sampled(texts, SAMPLE_UNLABELLED, 2), prior,
        counted=lambda known: _counted(_drawn(texts, wide, 2), known),
    )


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``(doc_id, score)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(shared.value.score(part.tolist()))

    udf = F.pandas_udf(scored, "double")
    return docs.select("doc_id", udf(F.col("text").cast("string")).alias("score"))


def _op6(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every whole text; learned from the rows that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    told = labels.filter(~held_out).filter("toxic IS NOT NULL")
    prior = told.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    toxic = told.filter("toxic = 1")
    classifier = train(docs.filter(~held_out), _few(toxic), min(0.5, max(1e-4, prior or 0.0)))
    scored = score(docs.select("doc_id", "text"), classifier)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def _few(toxic: DataFrame) -> DataFrame:
    """About twice as many ids as the sample takes, so that only their texts are fetched."""
    n = toxic.count()
    share = int(min(1.0, 2 * SAMPLE_POSITIVE / max(1, n)) * _UNIT)
    return toxic.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), F.lit(_UNIT)) < share)


add("op6_toxicity", _op6)
