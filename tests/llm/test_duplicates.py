"""N-gram join, embeddings, components."""

from __future__ import annotations

import random
import re

import numpy as np
from cases import PROSE, no_docs, odd_docs
from pyspark.sql import functions as F

from tidemark.llm import embeddings, graph, ngram_join
from tidemark.llm.queries import QUERIES


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 2000 + i) for i in range(50)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    proper = [(a, b) for a, b in links if a != b]
    assert found == roots({x for p in proper for x in p}, proper)
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = []
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                links.append((i, j))
    return {i: (len(sets[i]), c) for i, c in roots(ids, links).items()}


def near_copies(rng, n_bases=12, copies=14):
    """Chains and clouds of copies around the limit, passages that many share, short texts."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage, rows = [word() for _ in range(20)], []
    for _ in range(n_bases):
        text = [word() for _ in range(rng.choice([6, 12, 40, 90]))]
        for _ in range(copies):
            y = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                y[rng.randrange(len(y))] = word()
            if rng.random() < 0.3:
                y = y + passage
            if rng.random() < 0.3:
                text = y  # drift: links form chains
            rows.append(" ".join(y))
    rows += ["one two", "ONE\ttwo", "one", "", "  ", passage and " ".join(passage), " ".join(passage).upper()]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_join_brute_force(spark):
    for seed in (1, 2):
        rows = near_copies(random.Random(seed))
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
        assert found == brute(rows)


def test_join_does_not_depend_on_pivots(spark, monkeypatch):
    """Without any link from the pivots the token-group matrix finds all, also in groups of one or two."""
    rows = near_copies(random.Random(3), n_bases=6)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    true = ngram_join._pivots
    monkeypatch.setattr(ngram_join, "_pivots", lambda mixed, seed: true(mixed, seed).limit(3))
    monkeypatch.setattr(ngram_join, "GROUP", 2)
    monkeypatch.setattr(ngram_join, "QUERIES_PER_TASK", 3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert found == brute(rows)


def test_join_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = ngram_join.jaccard_components(docs).collect()
    assert len(rows) == docs.count()
    found = {r.doc_id: r.component_id for r in rows}
    assert found == {None: None, 1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, 10: 9, 11: 11}
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 1, 3, 4, 5, 6, 8, 9, 11]
    assert ngram_join.jaccard_components(no_docs(spark)).count() == 0


def test_join_query_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_ngram_join"](spark, folder).collect()}
    assert found == brute([tuple(r) for r in docs.collect()])


def vectors(rng, dimension=16):
    base = rng.normal(size=(40, dimension))
    rows = [b + rng.normal(size=dimension) * s for b in base for s in (0, 0.05, 0.1, 0.15, 0.2)]
    return [[float(np.float32(x)) for x in r] for r in rows + rows[:7]]


def test_embeddings_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rows = vectors(np.random.default_rng(5))
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    table = spark.createDataFrame(list(enumerate(rows + odd)) + [(None, rows[0])], "vec_id bigint, embedding array<float>")
    found = {r.vec_id: r for r in embeddings.near_duplicates(table.withColumn("rep", F.lit(1)), members_per_list=16).collect()}
    want = roots(range(len(rows)), list(zip(*np.nonzero(linked))))
    n = [found[i].n_links for i in range(len(rows))]
    assert sum(n) >= 0.98 * linked.sum() and all(a <= b for a, b in zip(n, linked.sum(axis=1)))
    assert sum(found[i].component_id == want[i] for i in range(len(rows))) >= 0.98 * len(rows)
    assert all(found[len(rows) + k].n_links == 0 and found[len(rows) + k].kept for k in range(6))
    assert [found[len(rows) + k].n_links for k in (6, 7)] == [1, 1] and not found[len(rows) + 7].kept
    assert found[None].n_links == 0 and found[None].component_id is None and len(found) == table.count()


def test_embeddings_with_more_lists_than_probes(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.standard_normal(x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    x = np.concatenate((x, 0.902 * x + np.sqrt(1 - 0.902**2) * u))
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(table, probes=2, members_per_list=8).collect()}
    got = np.array([found[i] for i in range(len(x))])
    assert (got <= want).all() and want.sum() >= 6000 and got.sum() >= 0.98 * want.sum()


def test_embeddings_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_embedding_query_recall(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in QUERIES["op10_embedding_dedup"](spark, folder).collect()}
    got = np.array([found[r.vec_id] for r in rows])
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()


def test_prose_constant_is_long_enough():
    assert len(PROSE.split()) >= 5
