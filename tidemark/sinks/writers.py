"""Sinks: labelled print, Kafka options, upsert by key (database, versioned table), idempotent micro-batch files."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidemark.sinks.versioned import VersionedTable


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows with the sink's label as first column."""
    return df.select(F.lit(label).alias("label"), "*")


def console(df: DataFrame, label: str | None = None):
    """Print: ``show`` for a table, a console query for a stream (the caller starts it)."""
    out = labelled(df, label) if label else df
    return out.writeStream.format("console") if df.isStreaming else out.show(truncate=False)


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka_rows(df: DataFrame, value: str) -> DataFrame:
    """The ``value`` column the Kafka sink writes."""
    return df.select(F.col(value).cast("string").alias("value"))


def last_per_key(df: DataFrame, keys: list[str], values: list[str], seq: Column) -> DataFrame:
    """The newest values of each key: what an upsert of every row in order leaves behind."""
    newest = F.max(F.struct(seq.alias("seq"), *values)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[f"newest.{v}" for v in values])


def upsert_rows(rows: Iterable[Row], connect: Callable, table: str, keys: list[str], values: list[str]) -> None:
    """UPDATE each row, INSERT where nothing was updated. ``connect`` returns a DB-API connection
    with '?' placeholders. Writing a row twice changes nothing, so a retried task is harmless."""
    sets, match = ", ".join(f"{v} = ?" for v in values), " AND ".join(f"{k} = ?" for k in keys)
    names = ", ".join([*keys, *values])
    marks = ", ".join("?" * (len(keys) + len(values)))
    connection = connect()
    try:
        cursor = connection.cursor()
        for row in rows:
            key, new = [row[k] for k in keys], [row[v] for v in values]
            cursor.execute(f"UPDATE {table} SET {sets} WHERE {match}", [*new, *key])
            if cursor.rowcount == 0:
                cursor.execute(f"INSERT INTO {table} ({names}) VALUES ({marks})", [*key, *new])
        connection.commit()
    finally:
        connection.close()


def database_upsert(connect: Callable, table: str, keys: list[str], values: list[str], seq: str):
    """A foreachBatch function: one row per key and batch, one connection per task."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = last_per_key(batch, keys, values, F.col(seq))
        newest.foreachPartition(lambda rows: upsert_rows(rows, connect, table, keys, values))

    return write


def batch_files(path: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d, by: Iterable[str] = ()):
    """A foreachBatch function writing one folder per micro-batch. A batch that runs again after a
    failure replaces its own folder, so nothing is doubled."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = transform(batch).write.mode("overwrite")
        writer.partitionBy(*by).parquet(f"{path}/batch={batch_id}")

    return write


def upsert_table(path: str, schema: str, keys: list[str], seq: str):
    """A foreachBatch function keeping the newest row of every key in a ``VersionedTable``; ``schema`` is that of
    the keys, ``seq`` and the values."""

    def write(batch: DataFrame, batch_id: int) -> None:
        VersionedTable(batch.sparkSession, path, keys, seq, schema).merge(batch, batch_id)

    return write


def upserted(spark: SparkSession, path: str, schema: str, keys: list[str], seq: str) -> DataFrame:
    """What the batches so far have left in the table, without ``seq``."""
    return VersionedTable(spark, path, keys, seq, schema).read().drop(seq)
