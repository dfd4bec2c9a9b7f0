"""Chat formatting: turn rows to one training string per conversation, with a loss mask.

The template marks every block of adjacent turns of one role and every turn inside it::

    <|role|>user<|text|>first turn<|next|>second turn of the same role<|end|>

Texts and roles cannot forge a mark: in them a backslash is put behind the first character of
everything that reads like a control string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``,
``<<SYS>>``, ``<</SYS>>``), and behind earlier backslashes there, so the escape can be undone exactly.

Defined cases: a null text or role is an empty one; a null turn number sorts first; a null
conversation id is a conversation of its own; repeated rows stay, ordered by (turn, role, text); an
empty table gives an empty result; other columns are ignored. Everything is a Spark expression. Cost
is linear in a conversation's text; only the offsets of the loss mask and reading by them grow with
turns x characters of one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import table
from tidemark.llm.queries import add

ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>"

# What follows the first character of a control string.
_TAIL = r"\||/?s>|/?INST\]|/?<SYS>>|</SYS>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_TAIL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_TAIL})", r"$1$2$3")


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as struct(role, texts)."""
    numbers = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(
        numbers,
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, F.greatest(i - 1, F.lit(0)))["role"]),
    )
    ends = F.concat(F.slice(starts, 2, F.size(turns)), F.array(F.size(turns)))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            F.get(turns, a)["role"].alias("role"),
            F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("texts"),
        ),
    )


def _pieces(block: Column, loss_role: str) -> Column:
    """The strings of a block in order, each with its share in the loss."""

    def piece(s: Column, loss: Column) -> Column:
        return F.struct(s.alias("s"), loss.alias("loss"))

    no, learns = F.lit(False), block["role"] == F.lit(loss_role)
    texts = F.transform(
        block["texts"],
        lambda t, i: F.array(piece(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)), no), piece(escape(t), learns)),
    )
    head = piece(F.concat(F.lit(ROLE), escape(block["role"]), F.lit(TEXT)), no)
    return F.flatten(F.array(F.array(head), F.flatten(texts), F.array(piece(F.lit(END), no))))


def format_chats(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``rows(conv_id, turn, role, text)`` to ``(conv_id, formatted, loss)``; ``loss`` holds the
    half-open code point spans of ``formatted`` that are learned, one per text of ``loss_role``."""
    clean = rows.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    blocks = turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    pieces = blocks.select("conv_id", F.flatten(F.transform("blocks", lambda b: _pieces(b, loss_role))).alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        after = acc["at"] + F.char_length(p["s"])
        span = F.struct(acc["at"].alias("start"), after.alias("end"))
        spans = F.when(p["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(after.alias("at"), spans.alias("spans"))

    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"),
        F.aggregate("pieces", start, step, lambda acc: acc["spans"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, texts unescaped: array of struct(role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        parts = F.split(block, r"<\|text\|>", -1)
        role = unescape(F.substring(F.get(parts, F.lit(0)), len(ROLE) + 1, 2_000_000_000))
        texts = F.split(F.get(parts, F.lit(1)), r"<\|next\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), ""
    )


def digests(formatted: DataFrame) -> DataFrame:
    read = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss")).alias("learned"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _op1(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the formatted strings."""
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_chats(rows.unionByName(own)))


_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
  length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|/?<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS chars,
  length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|/?<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS role_chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN before = role THEN 8 ELSE 23 + role_chars END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

add("op1_chat_format", _op1, _SQL)
