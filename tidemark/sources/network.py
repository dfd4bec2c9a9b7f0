"""Socket and Kafka sources: option builders and readers. Both need a service to read from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """One row per line; for demonstrations only, Spark cannot replay a socket after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_source_options(servers: str, topic: str, group: str | None = None, start: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_lines(spark: SparkSession, servers: str, topic: str, group: str | None = None, start: str = "latest") -> DataFrame:
    """String values of a topic (needs the Kafka connector package on the class path)."""
    reader = spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, group, start))
    return reader.load().select(F.col("value").cast("string").alias("value"))
