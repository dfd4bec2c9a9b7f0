"""Small tables with everything that can be odd about a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = "the cat sat on the mat and looked at the moon while it rained in the old town near the sea"
CLASHING = ["score", "n", "start", "part", "node", "rep", "token", "ids", "queue", "base", "spans", "held_out", "component", "h1", "owner", "item_id"]


def odd_docs(spark: SparkSession, clashing: bool = True) -> DataFrame:
    """Nulls in every column, empty and long texts, repeated rows; extra columns with names that the
    operators use themselves."""
    long = " ".join(f"{w}{i}" for i, w in enumerate((PROSE + " ").split() * 400))
    rows = [
        (1, PROSE, "en", "a", 3),
        (1, PROSE, "en", "a", 3),
        (2, PROSE, "en", None, None),
        (3, None, "en", "a", 0),
        (4, "", None, "b", 0),
        (5, "   \n\t ", "en", "b", 0),
        (6, long, "en", "b", 9),
        (7, long + " tail", None, "b", 9),
        (None, PROSE, "en", "c", 1),
        (None, None, None, None, None),
        (8, "1234 5678 !!", "en", "c", 1),
        (9, "one two three", "en", "c", 1),
        (10, "one  two\nTHREE", "de", "c", 1),
        (11, "x" * 50_000, "de", "c", 1),
    ]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumns({c: F.lit("extra") for c in CLASHING}) if clashing else df


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)
