from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import no_docs, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import encode, packing, tokenfile
from tidemark.llm.common import Words
from tidemark.llm.queries import QUERIES

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("cut, path", [(encode.DROPS_SPACE, WORD), (encode.KEEPS_SPACE, BYTE)])
def test_encoder_agrees_with_the_library(cut, path, monkeypatch):
    monkeypatch.setattr(encode, "REMEMBERED", 20)  # so that forgetting is tested as well
    ours, theirs, rng = encode.Encoder(path, cut), library(path), random.Random(5)
    signs = " \n \n\t\x0b \x1caBé'.!?s1́٣ßΣİ中\U0001f600-_<|endoftext|>'ll"
    for _ in range(60):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(8)] + [None, ""]
        for text, ids in zip(texts, ours.encode(texts, 7)):
            assert np.frombuffer(ids, ours.dtype).tolist() == theirs(text) + [7], repr(text)


def test_words_are_those_of_bytes_split():
    texts = ["A b\tC\x0bd", None, "", " x ", "Été  y", "A b"]
    w = Words(texts)
    split = [w.word(i) for i in range(len(w.hash))]
    assert split == [x for t in texts if t for x in t.encode().lower().split()]
    assert np.diff(w.first).tolist() == [4, 0, 0, 1, 2, 2] and w.hash[0] == w.hash[-2] != w.hash[1]


def written(spark, docs, tmp_path, **options):
    manifest = tokenfile.write_tokens(docs, str(tmp_path), WORD, end=2, **options)
    return sorted(tokenfile.read_tokens(spark, str(tmp_path), manifest).collect(), key=lambda r: r.start)


def test_token_files_round_trip(spark, tmp_path):
    docs, ids_of, start = odd_docs(spark), library(WORD), 0
    found = written(spark, docs, tmp_path, length=16, batch_rows=4)
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")
    wanted = sorted(docs.collect(), key=key)
    assert len(found) == len(wanted)
    for got, doc in zip(found, wanted):
        ids = ids_of(doc.text) + [2]
        assert (got.doc_id, got.start, got.n_tokens) == (doc.doc_id, start, len(ids))
        assert np.frombuffer(got.ids, "<u4").tolist() == ids
        start += len(ids)
    assert written(spark, no_docs(spark), tmp_path) == []


def test_sequences_are_views_of_the_file(spark, tmp_path):
    import pyarrow as pa

    tokenfile.write_tokens(odd_docs(spark), str(tmp_path), WORD, end=2, length=16, batch_rows=4)
    path = max(tmp_path.glob("tokens-*[0-9a-f].arrow"), key=lambda p: p.stat().st_size)
    reader = pa.ipc.open_file(pa.memory_map(str(path)))
    before = pa.total_allocated_bytes()
    batch = reader.get_batch(1)
    row = batch.column("ids").values.to_numpy(zero_copy_only=True)[16:32]
    assert len(row) == 16 and pa.total_allocated_bytes() == before


def test_packing_brute_force(spark):
    docs, ids_of = odd_docs(spark), library(BYTE)
    pieces = packing.pack(docs, BYTE, end=0, length=64, quantum=16)
    rows, by_doc = pieces.collect(), {}
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    at = 0
    for s, o, n in places:  # every window full but the last, no gap, no overlap
        assert (s, o) == divmod(at, 64) and o + n <= 64
        at += n
    wanted = sorted(ids_of(d.text) + [0] for d in docs.collect())
    assert at == sum(map(len, wanted))
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i in (2, 6, 7, 11):
        got = b"".join(r["ids"] for r in sorted(by_doc[i], key=lambda r: r["start"]))
        text = next(d.text for d in docs.collect() if d.doc_id == i)
        assert np.frombuffer(got, "<u4").tolist() == ids_of(text) + [0]
    assert packing.pack(no_docs(spark), BYTE, end=0).count() == 0


def test_schedule_is_deficit_round_robin():
    """The closed form against a simulation of the rounds."""
    totals, weights, length, quantum = [1000, 333, 4100, 16], [300_000, 200_000, 540_000, 8_576], 64, 16
    s = packing.Schedule(totals, weights, length, quantum)
    order, credit, sent = [], [0] * 4, [0] * 4
    while sum(sent) < sum(totals):
        for q in range(4):
            credit[q] += weights[q] * length
            while credit[q] >= quantum * (1 << 20) and sent[q] < totals[q]:
                n = min(quantum, totals[q] - sent[q])
                order.append((q, sent[q], n))
                credit[q], sent[q] = credit[q] - quantum * (1 << 20), sent[q] + n
    at = 0
    for q, start, n in order:
        assert s.place(np.array([q]), np.array([start // quantum]))[0] == at
        at += n


def test_windows_keep_the_mixture(spark):
    text = " word" * 4000
    docs = spark.createDataFrame([(i, text, "ab"[i % 3 == 0], 0) for i in range(12)], "doc_id int, text string, source string, n_chars int")
    rows = packing.pack(docs, BYTE, end=0).join(docs.select("doc_id", "source"), "doc_id")
    share = rows.groupBy("sequence_id").agg((F.sum(F.when(F.col("source") == "b", F.col("length"))) / F.sum("length")).alias("b"))
    low, high = share.filter("sequence_id < 46").agg(F.min("b"), F.max("b")).first()
    assert 0 <= low <= 1 / 3 <= high and high - low <= 0.5  # a quantum is a quarter of a window
    whole = packing.sequences(packing.pack(docs, BYTE, end=0)).collect()
    sizes = {len(r["ids"]) // 4 for r in whole}
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes) and sum(r["n_tokens"] for r in whole) == 12 * 4001


def test_queries_against_the_library(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r.doc_id: r for r in QUERIES["op2_token_files"](spark, folder).collect()}
    ids_of, start = library(WORD), 0
    for d in docs[:60]:
        ids = np.array(ids_of(d.text) + [2], dtype="<u4")
        assert (found[d.doc_id].start, found[d.doc_id].n_tokens) == (start, len(ids))
        assert found[d.doc_id].ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)
    packed = QUERIES["op4_pack_mixture"](spark, folder).collect()
    ids_of = library(BYTE)
    for d in docs[:30]:
        ids, at = np.array(ids_of(d.text) + [0], dtype="<u4"), 0
        for r in sorted((r for r in packed if r.doc_id == d.doc_id), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_places_of_very_large_queues():
    """10^13 tokens under a target of 10^-4 against whole numbers of Python."""
    totals, shares = [10**13, 4 * 10**13, 10**12], [1e-4, 0.9, 0.0999]
    weights = [round(packing._UNIT * s) for s in shares]
    for length, quantum in ((1024, 256), (1000, 255)):
        s = packing.Schedule(totals, weights, length, quantum)

        def sent(k):
            return [min(k * w * length // (packing._UNIT * quantum) * quantum, t) for w, t in zip(weights, totals)]

        for q, total in enumerate(totals):
            for j in (0, 1, 12345, total // quantum // 2, total // quantum - 1):
                k = -(-(j + 1) * packing._UNIT * quantum // (weights[q] * length))
                before, after = sent(k - 1), sent(k)
                want = sum(after[:q]) + sum(before[q + 1 :]) + j * quantum
                assert s.place(np.array([q]), np.array([j])).tolist() == [want] and want >= 0


def test_a_small_source_keeps_its_target(spark):
    rows = [(i, "word " * 50, f"s{i % 40}") for i in range(200)] + [(1000 + i, "rare " * 100, "rare") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = packing.pack(docs, BYTE, 0, length=256, quantum=64, targets={"rare": 0.5}, max_queues=8)
    rare = found.filter("doc_id >= 1000").agg(F.max("sequence_id"), F.sum("length")).first()
    assert rare[1] == found.filter("doc_id >= 1000").select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    assert rare[0] <= 2 * rare[1] // 256 + 2  # half of every window is its own until it is empty
