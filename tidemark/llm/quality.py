"""Quality rules: counts of a text, and how far its histograms diverge from those of a language.

Base rules count words, symbols, lines that were there before and words in repeated windows of eight;
they fail a text that is too short or too repetitive. All others are held against references, which
are counted over every document of the table that passes the base rules:

* the character classes of a text (small and capital letters, letters without case, marks, digits,
  white space, punctuation of prose, other signs, rest),
* its common words: the ``COMMON`` most frequent terms of a language, and one bin for all others.

The Jensen-Shannon distance (square root of the divergence, base 2: 0 alike, 1 disjoint) to a reference is
taken for both. A text fails if it is further than ``CLASS_LIMIT`` or ``WORD_LIMIT`` from every reference;
so a wrong or missing ``lang`` does no harm. Few characters or words say little about a distribution:
below ``MIN_CHARS`` or ``MIN_TERMS`` the respective rule does not speak.

A language has a reference if it holds a thousandth of all terms, which bounds their number by 1,000, and
there is one over all languages. References are small and go to the tasks; texts never leave theirs. What is
shuffled are term counts, summed in the tasks first.

Defined cases: a null text is empty; an empty text fails the base rules; repeated rows are judged each; a
null ``lang`` counts in the reference over all languages only; an empty table gives no rows; other columns
are never read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import Words, batches, mix, stored, table
from tidemark.llm.queries import add

MIN_WORDS = 20  # base rules
MOST_REPEATED = 30  # per cent of the words
WINDOW = 8
COMMON = 100
CLASS_LIMIT, MIN_CHARS = 0.3, 250
WORD_LIMIT, MIN_TERMS = 0.4, 120
LEAST_SHARE = 1000  # a language with one term in so many has a reference

_ALL = "\0all"  # name of the reference over all languages
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_GAP = np.ones(256, dtype=bool)  # terms are letters and digits of ASCII and everything beyond ASCII
_GAP[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False
_GAP[128:] = False
CLASSES = ("small", "capital", "letter", "mark", "digit", "space", "punctuation", "sign", "rest")
_KIND = {"Ll": 0, "Lu": 1, "Lt": 1, "Lo": 2, "Lm": 2, "Mn": 3, "Mc": 3, "Me": 3, "Nd": 4, "Nl": 4, "No": 4, "Zs": 5, "Zl": 5, "Zp": 5}
_PROSE = ".,;:!?'\"()-‐‑‒–—‘’“”„«»¿¡…"


@cache
def _class_table() -> np.ndarray:
    """The class of every code point."""
    rest = len(CLASSES) - 1
    out = np.array([_KIND.get(unicodedata.category(chr(i)), 7 if unicodedata.category(chr(i))[0] in "PS" else rest) for i in range(0x110000)], dtype=np.uint8)
    out[[ord(c) for c in _PROSE]] = 6
    out[9:14] = 5
    return out


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of flags between edges."""
    summed = np.concatenate(([0], np.cumsum(flags)))
    return summed[edges[1:]] - summed[edges[:-1]]


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _repeated(words: Words) -> np.ndarray:
    """Per text: words that stand in a window of WINDOW words found twice or more in it."""
    n = len(words.hash) - WINDOW + 1
    owner = words.owner()
    if n <= 0:
        return np.zeros(len(words.first) - 1, dtype=np.int64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        key = mix(key + words.hash[i : i + n])
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    order = inside[np.lexsort((key[inside], owner[inside]))]
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(words.hash) + 1, dtype=np.int64)
    np.add.at(cover, order[twice], 1)
    np.add.at(cover, order[twice] + WINDOW, -1)
    return _per_text(np.cumsum(cover[:-1]) > 0, words.first)


class Counted:
    """The counts of a list of texts as arrays, a value per text."""

    def __init__(self, texts: list[str | None]):
        words = Words(texts, lower=False)
        points = (words.raw & 0xC0) != 0x80  # first bytes of code points
        before = np.concatenate(([0], np.cumsum(points)))
        self.n_words = np.diff(words.first)
        in_words = before[words.end] - before[words.start]
        self.word_chars = _per_text(in_words, words.first)
        self.n_symbols = _per_text(_SYMBOL[words.raw], np.minimum(words.text_start, len(words.raw)))
        self.n_dup_lines = np.array([_dup_lines(t) for t in texts], dtype=np.int64)
        self.n_repeat_words = _repeated(words)
        self.base_failed = (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MOST_REPEATED * self.n_words)

        joined = "".join(t or "" for t in texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.n_chars = np.array([len(t or "") for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), self.n_chars)
        flat = np.bincount(owner * len(CLASSES) + _class_table()[code], minlength=len(texts) * len(CLASSES))
        self.classes = flat.reshape(len(texts), len(CLASSES))
        self.terms = Words(texts, gaps=_GAP)
        self.n_terms = np.diff(self.terms.first)


def distance(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of every row of ``counts`` from ``shares``; 0 for a row without counts."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + shares) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(shares > 0, shares * np.log2(shares / m), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(0, (left + right) / 2)), 0)


class Reference:
    """Histograms of a language: shares of the character classes, and of its common terms, known by their
    hash in ascending order, with the share of all other terms in the last bin."""

    def __init__(self, name: str, classes: list[int], terms: list[tuple[int, int]], n_terms: int):
        self.name = name
        self.classes = np.array(classes, dtype=float) / max(1, sum(classes))
        terms = sorted((h % (1 << 64), n) for h, n in terms)
        self.hash = np.array([h for h, _ in terms], dtype=np.uint64)
        known = [n for _, n in terms]
        self.words = np.array([*known, n_terms - sum(known)], dtype=float) / max(1, n_terms)

    def binned(self, terms: Words) -> np.ndarray:
        """Counts of the common terms, and of the others, per text."""
        width = len(self.hash) + 1
        at = np.minimum(np.searchsorted(self.hash, terms.hash), max(0, width - 2))
        bin_ = np.where(self.hash[at] == terms.hash, at, width - 1) if width > 1 else np.zeros(len(terms.hash), dtype=np.int64)
        n = len(terms.first) - 1
        return np.bincount(terms.owner() * width + bin_, minlength=n * width).reshape(n, width)


def _text_runs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in runs of a bounded size of text."""
    for part in parts:
        texts = part["text"].tolist()
        for a, b in batches(texts):
            yield part.iloc[a:b]


def references(docs: DataFrame, common: int = COMMON) -> list[Reference]:
    """References of the languages of ``docs(text, lang)`` and the one over all, see the head of the module."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes: dict[str, np.ndarray] = {}
        for run in _text_runs(parts):
            counted = Counted(run["text"].tolist())
            good, langs = ~counted.base_failed, run["lang"].to_numpy(dtype=object)
            number, names = pd.factorize(langs)  # -1: null
            for i, name in enumerate(names):
                mine = counted.classes[good & (number == i)].sum(axis=0)
                classes[name] = classes.get(name, 0) + mine
            classes[_ALL] = classes.get(_ALL, 0) + counted.classes[good].sum(axis=0)
            if len(classes) > 1000:
                yield _class_rows(classes)
                classes = {}
            owner = counted.terms.owner()
            use = good[owner]
            pairs = pd.DataFrame({"lang": number[owner][use], "term": counted.terms.hash[use].view(np.int64)})
            n = pairs.groupby(["lang", "term"], sort=False).size().reset_index(name="n")
            names = np.append(names, None)
            yield n.assign(lang=names[n["lang"].to_numpy()])[["lang", "term", "n"]].assign(kind=-1)
        yield _class_rows(classes)

    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInPandas(count, "lang string, term bigint, n bigint, kind int")
    summed = stored(counts.groupBy("lang", "kind", "term").agg(F.sum("n").alias("n")), "reference")
    classes = summed.filter("kind >= 0")
    terms = summed.filter("kind < 0").select("lang", "term", "n")
    whole = terms.groupBy("term").agg(F.sum("n").alias("n")).select(F.lit(_ALL).alias("lang"), "term", "n")
    sizes = terms.groupBy("lang").agg(F.sum("n").alias("n_terms"))
    total = sizes.agg(F.coalesce(F.sum("n_terms"), F.lit(0))).first()[0]
    # at most LEAST_SHARE languages hold such a share
    large = sizes.filter(F.col("lang").isNotNull() & (F.col("n_terms") * LEAST_SHARE >= total))
    n_terms = dict(large.collect()) | {_ALL: total}
    named = F.broadcast(large.select("lang"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "term")
    both = terms.join(named, "lang").select("lang", "term", "n").unionByName(whole)
    best = both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= common)
    words: dict[str, list[tuple[int, int]]] = {}
    for r in best.select("lang", "term", "n").collect():  # COMMON rows a reference
        words.setdefault(r["lang"], []).append((r["term"], r["n"]))
    hist = {name: [0] * len(CLASSES) for name in n_terms}
    for r in classes.join(named, "lang", "left_semi").unionByName(classes.filter(F.col("lang") == _ALL)).collect():
        hist[r["lang"]][r["kind"]] += r["n"]
    return [Reference(name, hist[name], words.get(name, []), n) for name, n in sorted(n_terms.items()) if n]


def _class_rows(classes: dict[str, np.ndarray]) -> pd.DataFrame:
    rows = [(name, 0, int(n), kind) for name, hist in classes.items() for kind, n in enumerate(hist) if n]
    return pd.DataFrame(rows, columns=["lang", "term", "n", "kind"])


_RULES = """doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,
base_failed boolean, kept boolean, class_distance double, word_distance double"""


def judged(docs: DataFrame, known: list[Reference]) -> DataFrame:
    """Counts and verdict of every row of ``docs(doc_id, text)``; the distances are those to the nearest
    reference, null where too few characters or words are there."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for run in _text_runs(parts):
            c = Counted(run["text"].tolist())
            far = np.full(len(run), np.inf)
            by_class, by_word = far.copy(), far.copy()
            for r in known:
                by_class = np.minimum(by_class, distance(c.classes, r.classes))
                by_word = np.minimum(by_word, distance(r.binned(c.terms), r.words))
            speaks = np.isfinite(far if not known else by_class)
            by_class = np.where(speaks & (c.n_chars >= MIN_CHARS), by_class, np.nan)
            by_word = np.where(speaks & (c.n_terms >= MIN_TERMS), by_word, np.nan)
            kept = ~c.base_failed & ~(by_class > CLASS_LIMIT) & ~(by_word > WORD_LIMIT)
            columns = {x: getattr(c, x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}
            distances = {"class_distance": pd.Series(by_class), "word_distance": pd.Series(by_word)}
            yield pd.DataFrame({"doc_id": run["doc_id"].astype("Int64").array, **columns, "kept": kept, **distances})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(judge, _RULES)


def _op12(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document, and whether it is kept."""
    docs = table(spark, folder, "documents")
    return judged(docs, references(docs))


add("op12_quality_rules", _op12)
