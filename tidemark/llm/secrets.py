"""Secret scans: fixed patterns, and character Markov models for everything else that looks random.

Two first-order character models, one of random strings and one of ordinary identifiers, are counted
over a labelled sample: what the patterns find are the random strings, long words outside of it the
ordinary ones. A run of 16 or more token characters outside of the patterns' spans is a secret when
its log-likelihood ratio, per transition, reaches ``margin``.

DataFrame functions only, on every path. Positions come from splitting a text at a pattern: pieces and
matches alternate, so their lengths add up to the offsets.

Defined cases: a null text is empty and has no spans; overlapping spans of different kinds are all
reported and redacted as one; repeated rows are scanned each; an empty table gives no rows; a sample
without random strings gives a model that finds nothing more; other columns are ignored by ``scan``
and kept by ``redact``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table
from tidemark.llm.queries import add

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# The same matches without those that are too short: such a match is always a whole run.
LONG_ACCESS, LONG_HEX = r"AKIA[A-Z0-9]{14,}", r"(?<![0-9a-f])[0-9a-f]{16,}"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
KINDS = ["assign", "access", "hex", "random"]

SAMPLE_DOCS = 20_000  # documents, in expectation, that the models are counted over
MARGIN = 0.8  # nats per transition
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
_ALPHABET = 96  # the printable ASCII characters, and one place for all others


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0, at_least: int = 0) -> Column:
    """Half-open code point spans of the leftmost matches, without those of short values."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    steps = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("gap"), found.alias("all"), values.alias("value"))
    none = F.expr(f"cast(array() as {_SPAN})")

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.char_length(m["gap"])
        end = start + F.char_length(m["all"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m["value"].alias("value"))
        kept = F.when(F.char_length(m["value"]) >= at_least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    walked = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), walked).otherwise(none)


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns, sorted by start and kind."""
    return F.sort_array(
        F.concat(_spans(text, ASSIGN, 0, value_group=2, at_least=12), _spans(text, LONG_ACCESS, 1), _spans(text, LONG_HEX, 2))
    )


def _outside(spans: Column, others: Column) -> Column:
    """The spans that touch none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])))


def _codes(value: Column) -> Column:
    """Characters as numbers below _ALPHABET."""
    code = F.transform(F.split(value, ""), lambda c: F.ascii(c) - 32)
    return F.transform(code, lambda x: F.when((x >= 0) & (x < _ALPHABET - 1), x).otherwise(_ALPHABET - 1))


def _transitions(value: Column) -> Column:
    codes = _codes(value)
    n = F.size(codes) - 1
    return F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: a * _ALPHABET + b)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratio (random to ordinary, nats) of every transition.

    The sample is chosen by a hash of the document's id, about ``sample_docs`` of all documents."""
    n = docs.count()
    share = int(min(1.0, sample_docs / max(1, n)) * (1 << 30))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sample = docs.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < share)
    found = sample.select(text.alias("text")).withColumn("base", base_spans(F.col("text")))
    ordinary = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9_])[A-Za-z_][A-Za-z0-9_]{7,}"), F.lit(0))
    labelled = found.select(
        F.explode(
            F.concat(
                F.transform("base", lambda s: F.struct(F.lit(1).alias("random"), s["value"].alias("value"))),
                F.transform(
                    F.filter(ordinary, lambda w: ~F.exists("base", lambda s: F.contains(s["value"], w))),
                    lambda w: F.struct(F.lit(0).alias("random"), w.alias("value")),
                ),
            )
        ).alias("x")
    ).select("x.random", F.explode(_transitions(F.col("x.value"))).alias("t"))
    counts = {(r["random"], r["t"]): r["n"] for r in labelled.groupBy("random", "t").agg(F.count("*").alias("n")).collect()}
    totals = [[0] * _ALPHABET, [0] * _ALPHABET]
    for (random, t), c in counts.items():
        totals[random][t // _ALPHABET] += c
    if not sum(totals[1]):
        return [-1.0] * _ALPHABET**2

    def log_p(random: int, t: int) -> float:
        return math.log((counts.get((random, t), 0) + 0.5) / (totals[random][t // _ALPHABET] + 0.5 * _ALPHABET))

    return [round(log_p(1, t) - log_p(0, t), 4) for t in range(_ALPHABET**2)]


def with_spans(docs: DataFrame, ratios: list[float], margin: float = MARGIN) -> DataFrame:
    """``docs(text, ...)`` with ``__spans``: those of the patterns, and random runs outside of them. The former are a
    column of their own (dropped again), which several expressions read, so Spark finds them once a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a constant, folded once into an array: the ratios as one literal
    ratio = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")

    def is_random(value: Column) -> Column:
        moves = _transitions(value)
        total = F.aggregate(moves, F.lit(0.0), lambda acc, t: acc + F.get(ratio, t))
        return total >= F.size(moves) * F.lit(margin)

    base = F.col("__base")
    runs = F.filter(_outside(_spans(text, RUN, 3), base), lambda s: is_random(s["value"]))
    found = docs.withColumn("__base", base_spans(text))
    return found.withColumn("__spans", F.sort_array(F.concat(base, runs))).drop("__base")


def scan(docs: DataFrame, ratios: list[float], margin: float = MARGIN) -> DataFrame:
    """``(doc_id, spans)`` of every row."""
    return with_spans(docs.select("doc_id", "text"), ratios, margin).select("doc_id", F.col("__spans").alias("spans"))


def redact(docs: DataFrame, ratios: list[float], margin: float = MARGIN, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; a text without secrets stays as it is."""
    text, found = F.col("text").cast("string"), F.col("__spans")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        out = F.when((s["start"] < acc["at"]), acc["out"]).otherwise(F.concat(acc["out"], gap))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def rebuilt(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, 2_000_000_000))

    clean = F.when(F.size(found) > 0, F.aggregate(found, start, step, rebuilt)).otherwise(text)
    out = with_spans(docs, ratios, margin).withColumn("text", clean).drop("__spans")
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else out


def digests(found: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", count(0), count(1), count(2), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def _op7(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every whole text."""
    docs = table(spark, folder, "documents")
    return digests(scan(docs, train(docs)))


add("op7_secret_scan", _op7)
