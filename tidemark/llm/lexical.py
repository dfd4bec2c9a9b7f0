"""Ranked lexical search by NRA: impact-sorted lists, read in order only, with score intervals.

Postings of the query terms are counted once per document (``index``). A task then takes its documents
in segments; in a segment every term has one list, sorted by impact (what an occurrence in that document
adds to a score). A search reads the lists of its terms from the top, all to the same depth, without
ever looking a document up:

* the lower bound of a document is the sum of the impacts read so far,
* its upper bound adds, for every list in which it has not come up yet, the next unread impact,
* a document never seen has the sum of the next unread impacts as its upper bound.

Reading goes on until nothing outside the best ``k`` can reach the k-th (a tie included) and the scores
of those ``k`` are exact. A segment starts with the k-th score of the earlier segments of its task, which
closes most lists early. Documents are disjoint over segments, so the best of all tasks together are the
answer, whatever the partitioning.

Only the postings (term numbers and counts) are written and read again; the texts are read once and
nothing but the ``k`` best of a task and item is shuffled. Items are searched in blocks of
``BLOCK_ITEMS``, which bounds what is broadcast; a block's terms are all that its index holds.

Defined cases: a null or empty text has no term and is never found; every row is a document of its own,
so repeated rows are found as often as they stand there; rows without an id come behind the others of
the same score; an item without a known term has no result; repeated items are answered once a row; a
null item id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import numbered, stored, table
from tidemark.llm.queries import add

# Bytes of a UTF-8 text: letters and digits of ASCII, and everything beyond ASCII.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_ITEMS = 5_000  # items searched in one pass
SEGMENT_DOCS = 1 << 15  # documents, and postings, whose lists are in memory at once
SEGMENT_POSTINGS = 1 << 21
FIRST_READ = 512  # entries of every list in the first round; doubles from round to round
_NO_ID = np.iinfo(np.int64).max  # stands for a null id, which sorts last

_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
_FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text with their repeats; ``bytes.lower`` lowers A-Z and nothing else."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def index(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Per document with a term: its number of terms ``n`` and, for the terms in ``numbers``, the
    occurrences. Column ``doc_id`` is null where the document has no id."""
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            ids, sizes, ends, terms, counts = [], [], [0], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                found = Counter(filter(known.__contains__, words))
                ids.append(doc)
                sizes.append(len(words))
                terms.extend(map(known.__getitem__, found))
                counts.extend(found.values())
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], schema=_INDEX)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, counts array<int>")


class Lists:
    """The impact-sorted lists of one segment: list t is ``doc[first[t]:first[t + 1]]``, best first.
    Documents are numbered in order of their id."""

    def __init__(self, ids, n, owner, term, tf, weight: np.ndarray, total_docs: int, total_terms: int):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        self.ids = ids[order]
        m = 100 - 90 + 90 * n * total_docs // max(1, total_terms)
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[owner]))
        useful = impact > 0
        term, impact, doc = term[useful], impact[useful], place[owner[useful]]
        best = np.lexsort((-impact, term))
        self.doc, self.impact = doc[best], impact[best]
        self.first = np.searchsorted(term[best], np.arange(len(weight) + 1))


def search(lists: Lists, terms: np.ndarray, k: int, floor: int = 0, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the ``k`` best documents of a segment, in order of score and number, without
    those that are sure to stay under ``floor``."""
    nothing = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    terms = terms[lists.first[terms] < lists.first[terms + 1]]
    if not len(terms):
        return nothing
    begin, end = lists.first[terms], lists.first[terms + 1]
    at = begin.copy()
    lower = np.zeros(len(lists.ids), dtype=np.int64)
    known = np.zeros(len(lists.ids), dtype=bool)
    seen = np.empty(0, dtype=np.int64)
    step = first_read
    while True:
        for i in np.flatnonzero(at < end):  # one sequential read of every list
            stop = min(at[i] + step, end[i])
            docs = lists.doc[at[i] : stop]
            lower[docs] += lists.impact[at[i] : stop]
            new = docs[~known[docs]]
            known[new] = True
            seen = np.concatenate((seen, new))
            at[i] = stop
        step *= 2
        ahead = np.where(at < end, lists.impact[np.minimum(at, len(lists.impact) - 1)], 0)
        unseen = int(ahead.sum())
        had = np.zeros(len(lists.ids), dtype=np.int64)  # next impacts of the lists in which a document has come up
        for i in np.flatnonzero(ahead):
            had[lists.doc[begin[i] : at[i]]] += ahead[i]
        low, upper = lower[seen], lower[seen] + unseen - had[seen]
        kth = max(floor, int(np.partition(low, len(low) - k)[len(low) - k]) if len(low) >= k else 1)
        open_ = upper >= kth  # may still be among the best; in a tie with the k-th the numbers decide
        if unseen < kth and np.array_equal(low[open_], upper[open_]):
            docs, scores = seen[open_], low[open_]
            best = np.lexsort((docs, -scores))[:k]
            return docs[best], scores[best]
        seen = seen[open_]  # bounds only close in: what has dropped out stays out


class _Segments:
    """Documents of a task gathered into segments, and the best ``k`` of every item so far."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, total_docs: int, total_terms: int, k: int, docs: int = SEGMENT_DOCS):
        self.items, self.weight, self.totals, self.k, self.most = items, weight, (total_docs, total_terms), k, docs
        self.best: list[list[tuple[int, int]]] = [[] for _ in items]  # (-score, id), in order
        self.waiting: list[tuple] = []
        self.docs = self.postings = 0

    def add(self, batch: pa.RecordBatch) -> None:
        ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        n = batch.column(1).to_numpy(zero_copy_only=False)
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        term, tf = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
        self.waiting.append((ids, n, np.repeat(np.arange(len(ids)), sizes) + self.docs, term, tf))
        self.docs += len(ids)
        self.postings += len(term)
        if self.docs >= self.most or self.postings >= SEGMENT_POSTINGS:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        lists = Lists(*(np.concatenate(x) for x in zip(*self.waiting)), self.weight, *self.totals)
        self.waiting, self.docs, self.postings = [], 0, 0
        for i, terms in enumerate(self.items):
            best = self.best[i]
            floor = -best[self.k - 1][0] if len(best) >= self.k else 0
            docs, scores = search(lists, terms, self.k, floor)
            if len(docs):
                found = zip((-scores).tolist(), lists.ids[docs].tolist())
                self.best[i] = sorted([*best, *found])[: self.k]


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of every item: ``(item_id, rank, doc_id, score)``.

    ``docs(doc_id, text)`` and ``items(item_id, text)``; see the head of the module."""
    spark = docs.sparkSession
    named = items.select("item_id", F.col("text").cast("string").alias("text"))
    asked = stored(numbered(named, ["item_id", "text"], "items").withColumnRenamed("id", "item"), "numbered")
    found = [_block(docs, asked.filter(F.col("item").between(a, a + BLOCK_ITEMS - 1)), k) for a in range(0, asked.count(), BLOCK_ITEMS)]
    if not found:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The best of every task for one block of items."""
    spark = docs.sparkSession
    asked = [(r["item"], sorted(set(terms_of(r["text"])))) for r in items.select("item", "text").collect()]
    numbers = {t: i for i, t in enumerate(sorted({t for _, ts in asked for t in ts}))}
    postings = stored(index(docs, numbers), "postings")
    total = postings.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # one row a term of the block
    weight = [math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(numbers))]
    terms = [np.array([numbers[t] for t in ts], dtype=np.int64) for _, ts in asked]
    sent = spark.sparkContext.broadcast((np.array([i for i, _ in asked], dtype=np.int64), terms, np.array(weight, dtype=np.int64)))
    n_docs, n_terms = total["docs"], total["terms"]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, terms, weight = sent.value
        segments = _Segments(terms, weight, n_docs, n_terms, k)
        for batch in batches:
            segments.add(batch)
        segments.flush()
        rows = [(number, doc, -score) for number, some in zip(numbers.tolist(), segments.best) for score, doc in some]
        frame = pd.DataFrame(rows, columns=["item", "doc_id", "score"], dtype="int64")
        frame["doc_id"] = frame["doc_id"].astype("Int64").mask(frame["doc_id"] == _NO_ID)
        yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return postings.mapInArrow(best, _FOUND)


def _op11(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


add(
    "op11_lexical_search",
    _op11,
    r"""
WITH cased AS (SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
d AS (SELECT doc, doc_id, len(terms) AS n, terms FROM cased WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * total.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM p, total WHERE term IN (SELECT term FROM asked) GROUP BY term, total.docs),
s AS (SELECT item_id, doc, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * total.docs) // total.terms)))) AS BIGINT)
    AS score FROM asked JOIN w USING (term) JOIN p USING (term), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
""",
)
