"""Ranked lexical search against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from cases import no_docs, odd_docs

from tidemark.llm import lexical
from tidemark.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    counted = [(d, t) for d, t in ((d, terms(t)) for d, t in docs) if t]
    total, length = len(counted), sum(len(t) for _, t in counted)
    out = []
    for item, text in items:
        scores = []
        wanted = set(terms(text))
        df = {w: sum(w in t for _, t in counted) for w in wanted}
        for d, t in counted:
            m, score = 100 - 90 + (90 * len(t) * total) // length, 0
            for w in wanted:
                tf = t.count(w)
                weight = math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1)))
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10):
    items = spark.createDataFrame(items, "item_id bigint, text string")
    result = lexical.ranked(docs, items, k)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


ITEMS = [(1, "the CAT sat, the cat!"), (2, "café_12 Ünder 5678"), (3, None), (4, "..."), (5, "unknown words"), (None, "one"), (6, "x" * 50_000 + " moon town sea")]


def test_odd_rows_against_brute_force(spark):
    docs = odd_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(spark, docs, ITEMS) == brute(rows, ITEMS)


def test_empty_tables(spark):
    assert found(spark, no_docs(spark), ITEMS) == []
    assert found(spark, odd_docs(spark), []) == []


def test_ties_and_repeated_rows_at_the_border(spark):
    rows = [(i % 30, "alpha beta") for i in range(60)] + [(100 + i, "alpha gamma delta") for i in range(5)] + [(None, "alpha beta")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    items = [(1, "alpha beta"), (2, "gamma"), (3, "beta delta")]
    for k in (1, 10, 61, 100):
        assert found(spark, docs, items, k) == brute(rows, items, k)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)
    docs = odd_docs(spark, clashing=False)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(spark, docs, ITEMS) == brute(rows, ITEMS)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_close_on_the_exact_scores(seed):
    """Random lists, read in steps of one, two and all at once; floors of earlier segments."""
    rng = np.random.default_rng(seed)
    n, n_terms = 200, 6
    owner, term = np.nonzero(rng.random((n, n_terms)) < rng.choice([0.05, 0.4, 0.9], n_terms))
    tf = rng.integers(1, 4, len(owner))
    size = rng.integers(3, 9, n)
    weight = rng.integers(0, 5000, n_terms)
    lists = lexical.Lists(np.arange(n) * 3, size, owner, term, tf, weight, n, int(size.sum()))
    m = 10 + 90 * size * n // size.sum()
    scores = np.zeros(n, dtype=np.int64)
    np.add.at(scores, owner, weight[term] * (10**9 * tf // (1000 * tf + 8 * m[owner])))
    want = sorted(((-s, d) for d, s in enumerate(scores.tolist()) if s > 0))
    for k in (1, 3, 10, 250):
        for step in (1, 2, 1000):
            docs, got = lexical.search(lists, np.arange(n_terms), k, first_read=step)
            assert list(zip((-got).tolist(), docs.tolist())) == want[:k]
        floor = -want[min(5, len(want) - 1)][0]
        docs, got = lexical.search(lists, np.arange(n_terms), k, floor, first_read=2)
        sure = [w for w in want[:k] if -w[0] >= floor]
        assert list(zip((-got).tolist(), docs.tolist()))[: len(sure)] == sure


def test_segments_of_a_task_are_one_result():
    random.seed(3)
    words = [f"w{i}" for i in range(12)]
    docs = [(i, [random.choice(words) for _ in range(random.randint(1, 9))]) for i in range(90)]
    numbers = {w.encode(): i for i, w in enumerate(words)}
    import pyarrow as pa

    def batch(part):
        counts = [{numbers[w.encode()]: t.count(w) for w in t} for _, t in part]
        lists = [pa.array([list(x) for x in y], pa.list_(pa.int32())) for y in ([c.keys() for c in counts], [c.values() for c in counts])]
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in part]), pa.array([len(t) for _, t in part]), *lists], schema=lexical._INDEX)

    items = [np.array([0, 3, 5]), np.array([1]), np.array([], dtype=np.int64)]
    results = []
    for docs_a_segment in (1, 7, 1000):
        segments = lexical._Segments(items, np.arange(100, 1300, 100), len(docs), sum(len(t) for _, t in docs), 5, docs_a_segment)
        for a in range(0, 90, 10):
            segments.add(batch(docs[a : a + 10]))
        segments.flush()
        results.append(segments.best)
    assert results[0] == results[1] == results[2] and len(results[0][0]) == 5 and results[0][2] == []


def test_query_against_sql(spark, folder):
    from check import compare, connect

    assert compare(QUERIES["op11_lexical_search"](spark, folder), connect(folder), ORACLES["op11_lexical_search"]) == []
