"""Text parsing: tokens, delimited rows, JSON fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.clock import SECOND


def tokens(text: Column, sep: str = " ") -> Column:
    """Split at every ``sep``; empty strings inside stay, trailing ones go.

    A text of separators only has no tokens; the empty text has one empty token.
    """
    body = F.rtrim(text, F.lit(sep))
    only_separators = (text != "") & (body == "")
    empty = F.array().cast("array<string>")
    return F.when(only_separators, empty).otherwise(F.split(body, f"\\Q{sep}\\E"))


def behavior_row(line: Column) -> list[Column]:
    """``user,item,category,type,seconds`` as typed columns; the time becomes microseconds."""
    part = F.split(line, ",")
    return [
        part.getItem(0).alias("user_id"),
        part.getItem(1).alias("item_id"),
        part.getItem(2).alias("category_id"),
        part.getItem(3).alias("type"),
        (part.getItem(4).cast("bigint") * F.lit(SECOND)).alias("us"),
    ]


def key_ts_row(line: Column) -> list[Column]:
    """``key seconds`` as key and microseconds."""
    part = F.split(line, " ")
    return [
        part.getItem(0).alias("key"),
        (part.getItem(1).cast("bigint") * F.lit(SECOND)).alias("us"),
    ]
