"""The registered queries of the subpackage: name -> (spark, folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Rows of a batch between Spark and Python: whole documents, so fewer than for numbers.
ARROW_ROWS = "2000"


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings that the operators rely on."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def add(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        return run(prepare(spark), folder)

    tuned.__name__, tuned.__doc__ = name, run.__doc__
    QUERIES[name] = tuned
    if sql:
        ORACLES[name] = sql.strip()
