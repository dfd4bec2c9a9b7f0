"""Registry of queries. A query takes (spark, table folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Common table expression of the oracle statements: events with time in microseconds and item id.
E = """e AS (SELECT event_id AS id, epoch_us(ts) AS us, user_id AS u, event_type AS t, value AS v,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; in ``sql`` the marks {E}, {H} and {D} stand for E, an hour and a day."""

    def add(run: Query) -> Query:
        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return run(tune(spark), folder)

        tuned.__name__, tuned.__doc__ = name, run.__doc__
        QUERIES[name] = tuned
        if sql:
            ORACLES[name] = sql.replace("{E}", E).replace("{H}", str(HOUR_US)).replace("{D}", str(DAY_US)).strip()
        return run

    return add
