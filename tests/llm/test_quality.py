"""Quality rules: counts and histograms against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from cases import no_docs, odd_docs

from tidemark.llm import quality
from tidemark.llm.queries import QUERIES

SPACES = " \t\n\v\f\r"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(SPACES):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    n = len(words)
    failed = n < 20 or 100 * len(inside) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def check(texts):
    got = quality.Counted(texts)
    for i, t in enumerate(texts):
        assert tuple(getattr(got, f)[i] for f in FIELDS) == counts(t), t


def test_counts_of_odd_texts():
    check([None, "", " \n\n \t", "a", "#*$%&|<> é", "x\nx\n x\nx\n\n\ny\r\ny\r\n", "w " * 30, "ñandú 12 \x0b b\x0cc", "日本語 テスト z"])
    check([])


def test_counts_of_random_texts():
    random.seed(1)
    texts = []
    for _ in range(200):
        words = [random.choice(["a", "b", "ab", "é", "#x", "|", "long-word"]) for _ in range(random.randint(0, 120))]
        if random.random() < 0.5:
            words += words[: random.randint(0, 40)]
        texts.append("".join(w + random.choice(["  ", " ", "\n", "\t"]) for w in words))
    check(texts)


def test_a_very_long_text():
    text = " ".join(f"w{i % 5000}\n" for i in range(300_000))
    got = quality.Counted([text])
    assert tuple(getattr(got, f)[0] for f in FIELDS) == counts(text)


def test_distance_is_jensen_shannon():
    rng = np.random.default_rng(5)
    q = rng.random(9)
    q[2] = 0
    q /= q.sum()
    c = rng.integers(0, 9, (20, 9))
    for row, got in zip(c, quality.distance(c, q)):
        p = row / row.sum()
        m = (p + q) / 2
        kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
        assert abs(got - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-9
    assert quality.distance(np.array([[1, 0], [0, 0]]), np.array([0.0, 1.0])).tolist() == [1.0, 0.0]


def prose(rng, n=200):
    common = ["the", "of", "and", "to", "in", "that"]
    return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)) + "."


def test_references_and_verdicts_against_plain_python(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng), "en") for i in range(150)] + [(150 + i, prose(rng), None) for i in range(20)]
    junk = {
        200: " ".join("".join(rng.choice("ABCDEFGHIJ") for _ in range(7)) + "!!" for _ in range(100)),
        201: " ".join(f"{rng.randrange(10**9)}" for _ in range(150)),
        202: " ".join("".join(rng.choice("ijklmnop") for _ in range(6)) for _ in range(200)),
    }
    rows += [(i, t, "en") for i, t in junk.items()] + [(300, "too short", "en"), (301, "same words all over again " * 20, "en"), (302, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    known = quality.references(docs)
    assert [r.name for r in known] == ["\0all", "en"]

    good = [(t, lang) for _, t, lang in rows if not counts(t)[-1]]
    for r in known:
        mine = [t for t, lang in good if r.name != "en" or lang == "en"]
        n = Counter(w for t in mine for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t.lower()))
        total = sum(n.values())
        assert np.allclose(sorted(r.words[:-1]), sorted(c / total for _, c in n.most_common(quality.COMMON)))
        kinds = Counter(int(quality._class_table()[ord(c)]) for t in mine for c in t)
        assert np.allclose(r.classes, [kinds[i] / sum(kinds.values()) for i in range(len(quality.CLASSES))])

    got = {r["doc_id"]: r for r in quality.judged(docs, known).collect()}
    assert len(got) == len(rows)
    assert {i for i, r in got.items() if not r["kept"]} == {*junk, 300, 301, 302}
    assert all(got[i]["base_failed"] for i in (300, 301, 302)) and not any(got[i]["base_failed"] for i in junk)
    assert got[300]["class_distance"] is None and got[0]["word_distance"] is not None


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = quality.judged(docs, quality.references(docs)).collect()
    assert len(out) == docs.count()
    want = sorted(((r["doc_id"], *counts(r["text"])) for r in docs.collect()), key=repr)
    assert sorted(((r["doc_id"], *[r[f] for f in FIELDS]) for r in out), key=repr) == want
    assert quality.judged(no_docs(spark), quality.references(no_docs(spark))).count() == 0
    assert quality.judged(docs, []).filter("kept AND NOT base_failed").count() == sum(not w[-1] for w in want)


def test_query_keeps_clean_documents_and_drops_junk(spark):
    folder = "/root/testdata/sf0.01"
    out = QUERIES["op12_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = out.join(texts, "doc_id").collect()
    for r in rows:
        assert tuple(r[f] for f in FIELDS) == counts(r["text"])
        assert not (r["base_failed"] and r["kept"])
    clean = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    signs = [r for r in rows if not r["base_failed"] and r["n_symbols"] > r["n_words"] and r["n_words"] > 60]
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean) > 100
    assert signs and not any(r["kept"] for r in signs)
