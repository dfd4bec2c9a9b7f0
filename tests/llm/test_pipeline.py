"""The pipeline's stages, each against a plain computation on the rows that it got."""

from __future__ import annotations

import random

import numpy as np
from cases import DOCS, no_docs, odd_docs
from pyspark.sql import functions as F
from test_duplicates import brute

import corpus_pipeline
from tidemark.llm import decontaminate
from tidemark.llm.common import stored


def test_stages_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, folder), "stage")
        if name == "packing":
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "language":
            assert after == {i: t for i, t in before.items() if any(map(str.isalpha, t))}
        elif name == "ngram_join":
            keep = {i for i, (_, c) in brute(list(before.items())).items() if i == c}
            assert after == {i: before[i] for i in keep}
        elif name == "decontaminate":
            leaks = decontaminate.Leaks(bench, decontaminate.Settings())
            for i in set(before) - set(after):
                words = decontaminate._words([before[i]]).hash.tolist()
                assert min(decontaminate.edits_within(w.tolist(), words) / len(w) for _, w in leaks.items) <= 0.25
            for i in after:
                words = decontaminate._words([after[i]]).hash
                near = [w for _, w in leaks.items if np.isin(w, words).sum() >= 0.75 * len(w)]
                assert all(decontaminate.edits_within(w.tolist(), words.tolist()) > 0.25 * len(w) for w in near)
        elif name == "secrets":
            assert set(after) == set(before)
            assert not any(s in t for t in after.values() for s in ("AKIA", 'token = "', "password="))
        docs, before = out, after
    pieces = out.collect()
    assert {r.doc_id for r in pieces} == set(before)
    assert sum(r["length"] for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_odd_rows_pass(spark, folder):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        rows = stored(stage(spark, docs, folder), "stage")
        docs = rows if "text" in rows.columns else docs
    assert rows.count() > 0
    empty = no_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_first_stage_rejects_what_is_in_no_language(spark, folder):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = {
        -1: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(60)),
        -2: " ".join("".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(20)),
        -3: "".join(rng.choice(letters.upper() + letters + "0123456789+/") for _ in range(600)),
        -4: "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. " * 5,
        -5: "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 4,
        -6: "for (int i = 0; i < n; i++) { sum += a[i] * b[i]; } " * 6,
    }
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = spark.createDataFrame([(i, t, None, "junk", len(t)) for i, t in junk.items()], DOCS)
    more = more.select(*[F.col(f.name).cast(f.dataType) for f in docs.schema])
    short = spark.createDataFrame([(-10, "The of and to the", None, "short", 17)], DOCS).select(more.columns)
    short = short.select(*[F.col(f.name).cast(f.dataType) for f in docs.schema])
    kept = corpus_pipeline.by_language(spark, docs.unionByName(more).unionByName(short), folder)
    assert {r.doc_id for r in kept.filter("doc_id < 0").select("doc_id").collect()} == {-10}
    assert kept.filter("doc_id >= 0").count() == docs.count()


def test_languages_are_predicted_once(spark, folder):
    """The filter on the language does not make Spark predict a second time below it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = corpus_pipeline.by_language(spark, docs, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
