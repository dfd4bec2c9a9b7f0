"""Phrase collocations against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from cases import no_docs, odd_docs

from tidemark.llm import collocations, common
from tidemark.llm.collocations import tiled_counts
from tidemark.llm.queries import ORACLES, QUERIES

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), w, f[lang, w[:k]], f[lang, w[k:]]))
    result = []
    for lang, found in out.items():
        longer = {}
        for _, a, _, w, *_ in found:
            if len(w) == 3:
                for part in (w[:2], w[1:]):
                    longer[part] = max(longer.get(part, 0), -a)
        kept = sorted(x for x in found if len(x[3]) == 3 or 100 * longer.get(x[3], 0) < 50 * -x[1])
        result += [(lang, i, " ".join(w), -a, left, right, n[lang], -s) for i, (s, a, _, w, left, right) in enumerate(kept[:top], 1)]
    return sorted(result)


def found(docs, **options):
    return sorted(tuple(r) for r in collocations.phrases(docs, **options).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(5)


@pytest.mark.parametrize("seed", range(2))
def test_random_texts_against_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "The", "THE", "é", "É", "x-y", "7", "\x00z"]
    rows = []
    for _ in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    docs = table(spark, rows)
    assert found(docs) == brute(rows)
    assert found(docs, least=3, top=7, chunk_tokens=50) == brute(rows, least=3, top=7)


def test_neighbours_are_looked_up_in_steps(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LOOKED_UP", 3)
    rows = [("en", "a b c d a b c, b c d a. " * 20), ("de", "a b c " * 15), ("en", "x")]
    assert found(table(spark, rows), least=3) == brute(rows, least=3) != []


def test_a_trimmed_worker_holds_no_tables():
    common.Words(["a " * 100_000])
    assert len(common._POW[0]) > 100_000
    common.trim_memory()
    assert len(common._POW[0]) == len(common._POW[1]) == 2
    assert len(set(common.Words(["a bc a bc " * 10]).hash)) == 2


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert found(docs, least=2) == brute(rows, least=2) != []
    assert found(no_docs(spark)) == [] and found(table(spark, [("en", "a b"), ("en", None), (None, "")])) == []


def test_repeats_and_a_long_text(spark):
    rows = [("en", "again " * 30_000), ("en", "new york city is new york " * 40), ("en", "york " * 11), ("de", "new york " * 9)]
    assert found(table(spark, rows)) == brute(rows)


def test_products_beyond_64_bits(spark):
    frame = spark.createDataFrame([(9 * 10**14, 9 * 10**14 + 1, 9 * 10**14)], "a bigint, l bigint, r bigint")
    assert frame.select(collocations._score("a", "l", "r")).first()[0] == 10**6 * (9 * 10**14) ** 2 // ((9 * 10**14 + 1) * 9 * 10**14)


@pytest.mark.parametrize("scale", [10, 3000, 1 << 33])
def test_tiles_count_like_a_dictionary(scale):
    rng = np.random.default_rng(scale)
    left, right = ((rng.random(40_000) ** 3 * scale).astype(np.int64) for _ in range(2))
    for tile, dense in ((4, 1), (64, 16), (512, 16)):
        got = collocations.tiled_counts(left, right, tile, dense)
        assert Counter(dict(zip(zip(got[0].tolist(), got[1].tolist()), got[2].tolist()))) == Counter(zip(left.tolist(), right.tolist()))
        assert len(set(zip(got[0].tolist(), got[1].tolist()))) == len(got[0])


def test_query_against_sql(spark, folder):
    from check import compare, connect

    assert compare(QUERIES["op13_collocations"](spark, folder), connect(folder), ORACLES["op13_collocations"]) == []


def test_pairs_are_counted_in_few_arrays():
    """Counting a chunk of words takes little more than the pairs themselves, and gives what a counter gives."""
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 1 << 20, 1 << 18), rng.integers(0, 1 << 20, 1 << 18)
    left[:1000], right[:1000] = 5, 7
    tracemalloc.start()
    found = tiled_counts(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak <= 8 * left.nbytes
    got = {(a, b): n for a, b, n in zip(*(x.tolist() for x in found))}
    assert got == Counter(zip(left.tolist(), right.tolist())) and len(got) == len(found[0])
