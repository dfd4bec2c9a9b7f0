"""Phrase collocation mining by direct-address tiling.

Words of a language are ranked by frequency, so a pair of words is a cell of a square and frequent words meet
in its upper left corner. The square is cut into tiles of ``TILE`` by ``TILE`` cells. A tile that many pairs of
a chunk fall into is counted in a dense array with ``numpy.bincount``; the pairs of all other tiles are sorted
as coordinates and counted in runs. Frequent pairs are then ranked themselves, and a phrase of three words is
the pair of a pair and a word: the same counting once more.

No dictionary is sent to the tasks. Texts are cut into chunks of some ``CHUNK_TOKENS`` words of one language,
numbered by a dictionary of their own; a chunk's words meet the ranked words in a join, and the ranks
come back to the chunk by its number. So memory in a task is a chunk and its dictionary, whatever the
vocabulary; what is shuffled are distinct words and pairs of chunks, and their word numbers.

Every word of a candidate has at least the candidate's frequency, so words and pairs under ``least`` take no
part in the next round.

Defined cases: a null text is empty; a null ``lang`` is ``und``; repeated rows count as often as they stand
there; a language without candidates has no row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import join_small, numbered, release_memory, stored, table, trimmed
from tidemark.llm.queries import add

CHUNK_TOKENS = 1 << 19  # what a Python worker holds follows it: its arrays of 8 bytes a word, some ten at once
TILE = 512
LOOKED_UP = 1 << 17  # neighbours that are looked up at once
DENSE = 16  # a tile is counted densely if it has one pair for so many cells
UNKNOWN = "und"

# Lower-case, and every character that ends a piece becomes a line feed.
_FOLD = bytes(10 if c in b".,;:!?\n\v\f\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_TOKEN = re.compile(rb"[^ \t\n]+|\n")
_BREAK = -1


class _Numbers(dict):
    """Numbers words as they come; the end of a piece is _BREAK."""

    def __init__(self):
        super().__init__({b"\n": _BREAK})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) - 1
        return n


class _Chunks:
    """Texts of a task gathered by language into chunks."""

    SCHEMA = pa.schema([
        ("chunk", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("ids", pa.binary()),
    ])

    def __init__(self, number: int, tokens: int):
        self.next, self.most = number << 32, tokens
        self.open: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        self.size = 0

    def add(self, lang: str, text: str) -> None:
        if lang not in self.open:
            self.open[lang] = (_Numbers(), [])
        numbers, runs = self.open[lang]
        tokens = _TOKEN.findall(text.encode("utf-8", "surrogatepass").translate(_FOLD))
        tokens.append(b"\n")
        runs.append(np.fromiter(map(numbers.__getitem__, tokens), dtype=np.int32, count=len(tokens)))
        self.size += len(tokens)

    @property
    def full(self) -> bool:
        return self.size >= self.most

    def take(self) -> pa.RecordBatch:
        rows = []
        for lang, (numbers, runs) in self.open.items():
            ids = np.concatenate(runs)
            del numbers[b"\n"]
            words = pa.array(list(numbers), pa.binary()).view(pa.string())
            counts = np.bincount(ids[ids >= 0], minlength=len(words))
            rows.append((self.next, lang, words, counts, ids.tobytes()))
            self.next += 1
        self.open, self.size = {}, 0
        ends = pa.array(np.cumsum([0, *(len(r[2]) for r in rows)]), pa.int32())
        words = pa.ListArray.from_arrays(ends, pa.concat_arrays([r[2] for r in rows]))
        counts = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([r[3] for r in rows]), pa.int64()))
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), words, counts]
        return pa.RecordBatch.from_arrays([*columns, pa.array([r[4] for r in rows], pa.binary())], schema=self.SCHEMA)


def _chunked(docs: DataFrame, tokens: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks(TaskContext.get().partitionId(), tokens)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chunks.add(lang, text)
                if chunks.full:
                    yield chunks.take()
        if chunks.size:
            yield chunks.take()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    rows = docs.select(lang, F.col("text").cast("string").alias("text")).filter(F.length("text") > 0)
    return rows.mapInArrow(trimmed(cut), "chunk bigint, lang string, words array<string>, counts array<bigint>, ids binary")


def tiled_counts(left: np.ndarray, right: np.ndarray, tile: int = TILE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers with their counts, each once, in no particular order."""
    if not len(left):
        return (np.empty(0, np.int64),) * 3
    width = int(right.max()) // tile + 1
    number = left // tile * width + right // tile
    tiles, sizes = np.unique(number, return_counts=True)
    found, rest = [], np.ones(len(left), dtype=bool)
    for t in tiles[sizes * dense >= tile * tile].tolist():
        here = np.flatnonzero(number == t)
        rest[here] = False
        cells = np.bincount(left[here] % tile * tile + right[here] % tile, minlength=tile * tile)
        used = np.flatnonzero(cells)
        found.append((t // width * tile + used // tile, t % width * tile + used % tile, cells[used]))
    if not rest.all():
        left, right = left[rest], right[rest]
    del number, rest
    if max(left.max(initial=0), right.max(initial=0)) >= 1 << 31:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        heads = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
        found.append((left[heads], right[heads], np.diff(np.append(heads, len(left)))))
    elif len(left):  # a pair is one number, sorted in its place
        key = left << 32
        key |= right
        key.sort()
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes, key = np.diff(np.append(heads, len(key))), key[heads]
        found.append((key >> 32, key & 0xFFFFFFFF, sizes))
    return found[0] if len(found) == 1 else tuple(np.concatenate(x) for x in zip(*found))


_PAIR = "left bigint, right bigint, n bigint"


def _pair_batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns.values()], names=list(columns))


def _numbered(chunks: DataFrame, located: DataFrame) -> DataFrame:
    """The texts of chunks in ranks: ``(chunk, ids)``, 64-bit numbers, _BREAK for a rare word or the end of a piece."""

    def number(chunk: pa.Table, ranks: pa.Table) -> pa.Table:
        release_memory()
        ids = np.frombuffer(chunk["ids"][0].as_py(), dtype=np.int32) if chunk.num_rows else np.empty(0, np.int32)
        known = np.full(int(ids.max(initial=_BREAK)) + 2, _BREAK, dtype=np.int64)  # the last cell is that of _BREAK
        known[ranks["pos"].to_numpy()] = ranks["id"].to_numpy()
        return pa.table({"chunk": chunk["chunk"], "ids": pa.array([known[ids].tobytes()] * chunk.num_rows, pa.binary())})

    left = chunks.select("chunk", "ids").groupBy("chunk")
    return left.cogroup(located.select("home", "pos", "id").groupBy("home")).applyInArrow(number, "chunk bigint, ids binary")


def _pairs_of(texts: DataFrame) -> DataFrame:
    """Counted pairs of neighbours per chunk."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(raw.as_buffer(), dtype=np.int64)
                both = (ids[:-1] >= 0) & (ids[1:] >= 0)
                left, right, n = tiled_counts(ids[:-1][both], ids[1:][both])
                yield _pair_batch({"chunk": np.full(len(n), chunk), "left": left, "right": right, "n": n})

    return texts.mapInArrow(trimmed(count), f"chunk bigint, {_PAIR}")


def _triples_of(texts: DataFrame, located: DataFrame) -> DataFrame:
    """Counted triples per chunk, as the number of their first pair and their last word."""
    step = LOOKED_UP

    def count(chunk: pa.Table, pairs: pa.Table) -> pa.Table:
        release_memory()
        if not chunk.num_rows or not pairs.num_rows:
            return pa.table(_pair_batch(dict.fromkeys(("left", "right", "n"), np.empty(0, np.int64))))
        ids = np.frombuffer(chunk["ids"][0].as_buffer(), dtype=np.int64)
        left, right, number = (pairs[c].to_numpy() for c in ("left", "right", "id"))
        # ranks of this chunk as small numbers, so that a pair is one number; looked up in steps, as arrays of a chunk add up
        used = np.unique(ids)
        key = np.searchsorted(used, left) * len(used) + np.searchsorted(used, right)
        order = np.argsort(key)
        key, number = key[order], number[order]
        pair = np.empty(max(0, len(ids) - 1), dtype=np.int64)
        for a in range(0, len(pair), step):
            part = ids[a : a + step + 1]
            small = np.searchsorted(used, part)
            here = small[:-1] * len(used) + small[1:]
            at = np.minimum(np.searchsorted(key, here), len(key) - 1)
            pair[a : a + step] = np.where((key[at] == here) & (part[:-1] >= 0) & (part[1:] >= 0), number[at], _BREAK)
        both = (pair[:-1] >= 0) & (pair[1:] >= 0)
        found = tiled_counts(pair[:-1][both], ids[2:][both])
        return pa.table(_pair_batch(dict(zip(("left", "right", "n"), found))))

    return texts.groupBy("chunk").cogroup(located.groupBy("chunk")).applyInArrow(count, _PAIR)


def _frequent(counted: DataFrame, least: int) -> DataFrame:
    return counted.groupBy("left", "right").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a^2 / (l r)) in exact arithmetic: products of 38 digits hold up to 10^16 occurrences."""
    return F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(16,0)) * {a}) div (CAST({left} AS DECIMAL(19,0)) * {right})").cast("bigint")


def phrases(docs: DataFrame, least: int = 10, top: int = 2000, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """The ``top`` phrases of two or three words of every language of ``docs(lang, text)``: ``(lang, rank, phrase,
    a, l, r, n, score)``, see the head of the module and the definitions of the score there are in the README."""
    chunks = stored(_chunked(docs, chunk_tokens), "chunks")
    words = chunks.select(F.col("chunk").alias("home"), "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w"))
    words = words.select("home", "lang", F.col("pos").cast("bigint").alias("pos"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    ranked = numbered(frequent, [F.col("lang"), F.desc("f"), F.col("word")], "words")
    texts = stored(_numbered(chunks, words.join(ranked.select("lang", "word", "id"), ["lang", "word"])), "ranks")

    counted = stored(_pairs_of(texts), "pairs")
    pairs = stored(numbered(_frequent(counted, least), [F.desc("a"), F.col("left"), F.col("right")], "frequent"), "ranked")
    located = join_small(counted.drop("n"), pairs.select("left", "right", "id"), ["left", "right"])
    triples = stored(_frequent(_triples_of(texts, located), least), "triples")
    return _best(ranked, pairs, triples, totals, top)


def _best(words: DataFrame, pairs: DataFrame, triples: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Scores, phrases that stand inside longer ones removed, and the best of every language."""
    first, second = (pairs.select(F.col("id").alias(f"{p}_id"), F.col("left").alias(x), F.col("right").alias(y), F.col("a").alias(f"f_{p}"))
                     for p, x, y in (("head", "w1", "w2"), ("tail", "w2", "w3")))
    three = triples.select(F.col("left").alias("head_id"), F.col("right").alias("w3"), "a").join(first, "head_id").join(second, ["w2", "w3"])
    inside = three.select(F.col("head_id").alias("id"), "a").unionByName(three.select(F.col("tail_id").alias("id"), "a"))
    longest = inside.groupBy("id").agg(F.max("a").alias("longer"))
    free = pairs.join(longest, "id", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))

    def word(number: str, text: str, f: str) -> DataFrame:
        return words.select(F.col("id").alias(number), F.col("word").alias(text), F.col("f").alias(f), *(["lang"] if number == "w1" else []))

    two = free.select(F.col("left").alias("w1"), F.col("right").alias("w2"), "a")
    two = two.join(word("w1", "t1", "l"), "w1").join(word("w2", "t2", "r"), "w2")
    two = two.select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = three.join(word("w1", "t1", "f1"), "w1").join(word("w2", "t2", "f2"), "w2").join(word("w3", "t3", "f3"), "w3")
    early, late = _score("a", "f1", "f_tail"), _score("a", "f_head", "f3")
    three = three.select(
        "lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a",
        F.when(late < early, F.col("f_head")).otherwise(F.col("f1")).alias("l"),
        F.when(late < early, F.col("f3")).otherwise(F.col("f_tail")).alias("r"),
        F.least(early, late).alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _op13(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of every language of the documents."""
    return phrases(table(spark, folder, "documents"))


add(
    "op13_collocations",
    _op13,
    r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM documents),
g AS (SELECT lang, 1 AS k, unnest(ws) AS phrase FROM p
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: concat_ws(' ', ws[i], ws[i + 1]))) FROM p
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]))) FROM p),
f AS (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
cut AS (SELECT c.lang, c.k, c.phrase, c.a, c.w, x.k AS cut_at, x.a AS l, y.a AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score FROM c
    JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.phrase = array_to_string(c.w[1:x.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.phrase = array_to_string(c.w[x.k + 1:], ' ')),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
inner_ AS (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3),
kept AS (SELECT * FROM lowest o WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = o.lang AND i.phrase = o.phrase AND 100 * i.a >= 50 * o.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""",
)
