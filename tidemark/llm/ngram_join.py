"""N-gram Jaccard join by a token-group matrix.

A document is the set of its distinct five-word shingles (64-bit hashes); two documents link when
``100 * |A & B| >= 75 * |A | B|``. The join is exact:

1. Equal sets are one class with one representative. The same pass counts how often shingles of each
   of 2^22 hash slots occur: a sketch of fixed size that only sets the order, rare slots first, in
   which the shingles of a set are listed.
2. In any common order, two linked sets share at least l(n) = max(1, n // 10) of their first
   ``n - ceil(3 n / 4) + l(n)`` shingles (l of the smaller set). Representatives emit this prefix;
   shingles that only one of them has are dropped, then sets with fewer than l shared ones (those
   that have a passage or two in common with others). This is the only table
   as large as the corpus, and it is shuffled once.
3. Partition: every set is compared with a few pivots of the shingles it shares; what links is one
   component, so the copies of one text need no pairs among themselves.
4. Token-group matrix: similar sets, linked or not, are put into groups: those whose most common shared
   shingle is the same (a passage, or the text that copies were made of) and that are about as large,
   GROUP at a time. The matrix holds which prefix shingles a group's sets have. A set asks the groups of its
   own number and above that share one with it; its overlap with the union of a group bounds its overlap
   with any member, so only groups with ``|Q & union| >= 3/4 |Q|`` are opened and compared set by set.
   Whatever is missing from step 3 is found here, so the components do not depend on the pivots.

Links leave a task as a forest over its nodes, so components are found from about as many links as nodes.

Words are runs of bytes other than the six ASCII spaces, A-Z lowered. Defined cases: with fewer than
five words the whole sequence is the one shingle; a null text or one without words has none and links
with nothing; a null id links with nothing and has a null component; repeated rows get a row each
(ids are taken to name one text); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import Words, batches, finished, join_small, mix, stored, table, trimmed
from tidemark.llm.graph import components, thinned
from tidemark.llm.queries import add

WIDTH = 5
SLOT_BITS = 22
_BLOCKS = 16  # the counts of the slots travel in so many pieces
GROUP = 64  # sets in a group
ROUNDS = 1  # of pivots; more only save work, and three saved none on the tables here
QUERIES_PER_TASK = 1024  # sets that ask one group, after which it is dealt out to more tasks
_LOW = np.uint64((1 << (64 - SLOT_BITS)) - 1)


def shingle_sets(texts: list) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every text."""
    for a, b in batches(texts):
        words = Words(texts[a:b])
        size = np.diff(words.first)
        h = words.hash
        rolled = np.full(max(0, len(h) - WIDTH + 1), WIDTH, dtype=np.uint64)
        for k in range(WIDTH if len(rolled) else 0):
            rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(rolled)])
        for first, n in zip(words.first[:-1].tolist(), size.tolist()):
            if n >= WIDTH:
                yield np.unique(rolled[first : first + n - WIDTH + 1])
            elif n:
                short = np.array([n], dtype=np.uint64)
                for k in range(n):
                    short = mix(short * np.uint64(0xC2B2AE3D27D4EB4F) + h[first + k : first + k + 1])
                yield short
            else:
                yield np.empty(0, dtype=np.uint64)


def prefix_size(n: int) -> int:
    return n - (3 * n + 3) // 4 + max(1, n // 10) if n else 0


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 75 * (len(x) + len(y) - both)


def _prints(docs: DataFrame) -> DataFrame:
    """Size and fingerprint of every document's set, and the slot counts of every partition."""
    schema = "doc_id bigint, n bigint, h1 bigint, h2 bigint, part int, block int, counts binary"

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        for part in parts:
            n, h1, h2 = [], [], []
            for s in shingle_sets(part["text"].tolist()):
                n.append(len(s))
                h1.append(int(mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)))
                h2.append(int(mix(s + np.uint64(0x27D4EB2F165667C5)).sum(dtype=np.uint64)))
                slots[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)] += 1  # a set's rare double slot counts once
            prints = [np.array(h, dtype=np.uint64).view(np.int64) for h in (h1, h2)]
            yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "n": n, "h1": prints[0], "h2": prints[1], "part": None, "block": None, "counts": None})
        packed = [zlib.compress(x.tobytes(), 1) for x in np.split(slots, _BLOCKS)]
        number = TaskContext.get().partitionId()
        if slots.any():
            none = pd.array([None] * _BLOCKS, dtype="Int64")
            yield pd.DataFrame({"doc_id": none, "n": none, "h1": none, "h2": none, "part": number, "block": range(_BLOCKS), "counts": packed})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInPandas(trimmed(scan), schema), "prints")


def _slot_ranks(prints: DataFrame) -> np.ndarray:
    """The rank of every slot, rarest first. Summed in two levels; 2^22 numbers reach the driver."""

    def summed(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SLOT_BITS) // _BLOCKS, dtype=np.int64)
        for c in part["counts"]:
            raw = zlib.decompress(c)
            total += np.frombuffer(raw, dtype=np.int32 if len(raw) == 4 * len(total) else np.int64)
        return pd.DataFrame({"block": part["block"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    counts = prints.filter("block IS NOT NULL").select("block", F.pmod("part", F.lit(32)).alias("g"), "counts")
    level = counts.groupBy("block", "g").applyInPandas(summed, "block int, counts binary")
    rows = level.groupBy("block").applyInPandas(summed, "block int, counts binary").collect()
    total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for r in rows:
        each = len(total) // _BLOCKS
        total[r["block"] * each : (r["block"] + 1) * each] = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.int64)
    rank = np.empty(len(total), dtype=np.uint32)
    rank[np.argsort(total, kind="stable")] = np.arange(len(total), dtype=np.uint32)
    return rank


def _shared_tokens(reps: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Prefix shingles ``(token, node, n)`` that more than one representative has."""
    rank = reps.sparkSession.sparkContext.broadcast(ranks)

    def prefixes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            tokens, sizes, early = [np.empty(0, np.uint64)], [], [np.empty(0, bool)]
            for s in shingle_sets(part["text"].tolist()):
                first = rank.value[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64)
                tokens.append(np.sort(first << np.uint64(64 - SLOT_BITS) | s & _LOW)[: prefix_size(len(s))])
                sizes.append(len(s))
                early.append(np.arange(len(tokens[-1])) <= len(s) - (3 * len(s) + 3) // 4)
            count = np.array([len(t) for t in tokens[1:]], dtype=np.int64)
            yield pd.DataFrame({
                "token": np.concatenate(tokens).view(np.int64),
                "node": np.repeat(part["doc_id"].to_numpy(np.int64), count), "n": np.repeat(np.array(sizes, dtype=np.int32), count),
                "early": np.concatenate(early),
            })

    emitted = reps.select("doc_id", "text").mapInPandas(trimmed(prefixes), "token bigint, node bigint, n int, early boolean")
    same = Window.partitionBy("token")
    ends = emitted.withColumns({"least": F.min("node").over(same), "most": F.max("node").over(same)})
    shared = stored(ends.filter("least < most").select("token", "node", "n", "early"), "shared-tokens")
    need = F.greatest(F.lit(1), F.floor(F.ceil(3 * F.col("n") / 4) / 10))
    counted = shared.groupBy("node").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    enough = stored(counted.filter(F.col("c") >= need).select("node"), "nodes-left")
    left = join_small(shared.filter("early"), enough, ["node"])
    ends = left.withColumns({"least": F.min("node").over(same), "most": F.max("node").over(same)})
    # linked sets share one of their first n - ceil(3 n / 4) + 1; the others have done their work
    early = stored(ends.filter("least < most").select("token", "node", "n"), "early-tokens")
    finished(shared, enough)
    return early


def _fits(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can link at all."""
    return (4 * F.least(n, m)) >= (3 * F.greatest(n, m))


def _mixed(shared: DataFrame, parts: DataFrame | None) -> DataFrame:
    """The rows, with their node's component, of shingles that several components have."""
    if parts is None:
        return shared.withColumn("component", F.col("node"))
    placed = join_small(shared, parts, ["node"], "left").select("token", "node", "n", F.coalesce("component", "node").alias("component"))
    same = Window.partitionBy("token")
    ends = placed.withColumns({"least": F.min("component").over(same), "most": F.max("component").over(same)})
    return stored(ends.filter("least < most").drop("least", "most"), "mixed-tokens")


def _pivots(mixed: DataFrame, seed: int) -> DataFrame:
    """``(node, gid)``: for every node the pivot, in another component, that it shares most shingles
    with. Part of the shingles serve at first: what this misses, later rounds and the matrix find."""
    if not seed:
        mixed = mixed.filter(F.pmod(F.xxhash64("token"), F.lit(4)) == 0)
    pivot = F.struct(F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("component").alias("pc"))
    chosen = mixed.groupBy("token").agg(F.min_by(pivot, F.xxhash64("node", F.lit(seed))).alias("p"))
    pairs = mixed.join(chosen, "token").select("node", "n", "component", "p.*")
    other = pairs.filter((F.col("component") != F.col("pc")) & _fits(F.col("n"), F.col("pn")))
    counted = other.groupBy("node", "pivot").agg(F.count("*").alias("c"))
    best = counted.groupBy("node").agg(F.max_by("pivot", F.struct("c", "pivot")).alias("gid"))
    return stored(best, "pivots")


def _sets(reps: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, n, tokens)`` of the nodes: only these texts are read again."""

    def full(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = list(shingle_sets(part["text"].tolist()))
            yield pd.DataFrame({"node": part["doc_id"], "n": [len(s) for s in found], "tokens": [s.tobytes() for s in found]})

    chosen = join_small(reps.select("doc_id", "text"), nodes.select(F.col("node").alias("doc_id")), ["doc_id"], "left_semi")
    return stored(chosen.mapInPandas(trimmed(full), "node bigint, n int, tokens binary"), "sets")


def _opened(queries: DataFrame, members: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """Links ``(a, b)`` of ``queries(node, component, gid)`` with sets of ``members(gid, node, component)``, as many as
    join all that link there. A group's sets are held by a task, its queries stream by."""
    load = queries.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES_PER_TASK).cast("int").alias("tasks"))
    row = [F.lit(1).alias("asks"), "node", "component"]
    asked = queries.join(load, "gid").select("gid", F.pmod(F.xxhash64("node"), F.col("tasks")).cast("int").alias("salt"), *row)
    row = [F.lit(0).alias("asks"), "node", "component"]
    held = members.join(load, "gid").select("gid", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"), *row)
    rows = asked.union(held).join(sets, "node").select("gid", "salt", "asks", "node", "component", "tokens")
    dealt = rows.repartition("gid", "salt").sortWithinPartitions("gid", "salt", "asks", "node")

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, inside, union, joined = None, [], None, {}

        def root(x: int) -> int:
            while joined.get(x, x) != x:
                joined[x] = x = joined.get(joined[x], joined[x])
            return x

        for part in parts:
            a, b = [], []
            for gid, salt, asks, node, component, tokens in zip(*(part[c] for c in part.columns)):
                if (gid, salt) != group:
                    group, inside, union, joined = (gid, salt), [], None, {}
                s = np.frombuffer(tokens, dtype=np.uint64)
                if not asks:
                    inside.append((node, component, s))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([t for *_, t in inside])) if inside else np.empty(0, np.uint64)
                if len(inside) > 1 and 4 * len(np.intersect1d(s, union, assume_unique=True)) < 3 * len(s):
                    continue
                for other, its, t in inside:
                    if 4 * min(len(s), len(t)) >= 3 * max(len(s), len(t)) and root(component) != root(its) and similar(s, t):
                        joined[root(component)] = root(its)
                        a.append(node)
                        b.append(other)
            yield pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return stored(dealt.mapInPandas(trimmed(compare), "a bigint, b bigint"), label)


def _grouped(cross: DataFrame) -> DataFrame:
    """``(node, component, gid)``: similar sets in one group. The shingle of a set that most sets share tells what
    it is similar to; sets of one group differ in size by a third at most, beyond which nothing links."""
    common = cross.groupBy("token").agg(F.count("*").alias("c"))
    named = cross.join(common, "token").groupBy("node", "component", "n").agg(F.max(F.struct("c", "token"))["token"].alias("hub"))
    named = named.withColumn("grade", F.floor(F.log(F.col("n")) / F.log(F.lit(4 / 3))))
    sizes = named.groupBy("hub", "grade").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    bucket = F.pmod(F.xxhash64("node"), F.col("groups"))
    return named.join(sizes, ["hub", "grade"]).select("node", "component", F.xxhash64("hub", "grade", bucket).alias("gid"))


def _remaining(cross: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components, by the token-group matrix."""
    grouped = stored(_grouped(cross), "groups")
    rows = cross.join(grouped.select("node", "gid"), "node").select("token", "node", "n", "component", "gid")
    sizes = [F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("first"), F.max("component").alias("last")]
    matrix = rows.groupBy("token", F.col("gid").alias("group")).agg(*sizes)
    can = (4 * F.col("high") >= 3 * F.col("n")) & (3 * F.col("low") <= 4 * F.col("n"))
    others = (F.col("first") != F.col("component")) | (F.col("last") != F.col("component"))
    asked = rows.join(matrix, "token").filter((F.col("gid") <= F.col("group")) & can & others)
    asked = stored(asked.select("node", "component", F.col("group").alias("gid")).distinct(), "asked")
    return _opened(asked, grouped, sets, "links-of-groups")


def _copies(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document with its class's smallest id, and the classes of several documents."""
    own = prints.filter("block IS NULL").select("doc_id", "n", "h1", "h2")
    counted = own.filter("n > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    several = stored(counted.filter("copies > 1").select("h1", "h2", "n", "rep"), "copies")
    placed = join_small(own, several, ["h1", "h2", "n"], "left")
    return placed.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")), several


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, n_shingles, component_id)``, a row each."""
    prints = _prints(docs)
    placed, several = _copies(prints)
    placed = stored(placed, "classes")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spare = placed.filter("doc_id <> rep").select("doc_id")
    reps = join_small(texts.filter("doc_id IS NOT NULL AND text IS NOT NULL"), spare, ["doc_id"], "left_anti")
    ranks = _slot_ranks(prints)
    finished(prints, several)
    shared = _shared_tokens(reps, ranks)
    nodes = stored(shared.select("node").distinct(), "nodes")
    sets = _sets(reps, nodes)
    finished(nodes)
    links = parts = None
    for seed in range(ROUNDS):
        pivots = _pivots(_mixed(shared, parts), seed)
        asked = pivots.withColumn("component", F.col("node"))
        held = pivots.select("gid", F.col("gid").alias("node"), F.col("gid").alias("component")).distinct()
        more = _opened(asked, held, sets, "links-of-pivots")
        finished(pivots)
        links = more if links is None else links.union(more)
        parts = stored(components(links), "parts")
    mixed = _mixed(shared, parts)
    finished(shared)
    more = _remaining(mixed, sets)
    finished(sets, mixed)
    found = stored(components(links.union(thinned(more))).toDF("rep", "component"), "components")
    out = join_small(placed, found, ["rep"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents but for those that are linked to a smaller id, one of each component staying."""
    dropped = stored(jaccard_components(docs).filter("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    kept = docs.withColumn("_id", F.col("doc_id").cast("bigint"))
    return join_small(kept, dropped.toDF("_id"), ["_id"], "left_anti").select(*docs.columns)


def _op5(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return jaccard_components(table(spark, folder, "documents").select("doc_id", "text"))


add("op5_ngram_join", _op5)
