"""Running streams: start, drain, end-of-stream marker, values carried from batch to batch."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import storage
from tidemark.session import ROCKSDB_PROVIDER, new_scratch
from tidemark.sources.files import FAR_FUTURE

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # commit the changes of a micro-batch, not the whole store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    write: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Start a query into Parquet files at ``path`` or into a foreachBatch function ``write``.

    ``every`` is the trigger interval ("10 seconds"); without it the query takes what is there and
    stops. State is kept in RocksDB and everything restarts from ``checkpoint``. The first start
    fixes the number of state partitions at that of the session's shuffles.
    """
    for key, value in STATE_CONF.items():
        df.sparkSession.conf.set(key, value)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if write:
        return writer.foreachBatch(write).start()
    return writer.format("parquet").option("path", path).start()


def drain(
    df: DataFrame,
    writer: Callable[[str], Callable[[DataFrame, int], None]] | None = None,
    mode: str = "append",
    end: EndMarker | None = None,
    partitions: int | None = None,
) -> str:
    """Run a query over all that is there and return the folder of its output.

    ``writer(path)`` makes a foreachBatch function; without it rows go to Parquet files. With an
    ``end`` marker the query is run to the end of its data, then once more from its checkpoint with
    the marker in place. ``partitions`` is the number of state partitions, if not the session's.
    """
    path = new_scratch(df.sparkSession, "stream")
    write = writer(f"{path}/out") if writer else None
    conf = df.sparkSession.conf
    shuffles = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(partitions or shuffles))
    try:  # a query copies the session's settings some time after its start: wait for its end
        start(df, f"{path}/checkpoint", f"{path}/out", write, mode).awaitTermination()
        if end:
            end.put()
            start(df, f"{path}/checkpoint", f"{path}/out", write, mode).awaitTermination()
    finally:
        conf.set("spark.sql.shuffle.partitions", shuffles)
    return f"{path}/out"


def drained(
    df: DataFrame,
    writer: Callable[[str], Callable[[DataFrame, int], None]] | None = None,
    mode: str = "append",
    end: EndMarker | None = None,
    schema=None,
    partitions: int | None = None,
) -> DataFrame:
    """What a drained query wrote (possibly nothing)."""
    path = drain(df, writer, mode, end, partitions)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


class EndMarker:
    """One row far in the future, to be put at the end of a stream.

    Spark closes a window only when later rows move the watermark past it, and has no end-of-input
    watermark; the marker moves it past everything. ``values`` fill columns of the marker (the rest
    is null); the marker's own window never closes.
    """

    def __init__(self, stream: DataFrame, **values: object):
        self.spark, self.path = stream.sparkSession, new_scratch(stream.sparkSession, "end")
        columns = []
        for field in stream.schema.fields:
            value = F.lit(values.get(field.name))
            if field.name == "ts":
                value = F.lit(FAR_FUTURE)
            elif field.name == "us":
                value = F.unix_micros(F.lit(FAR_FUTURE).cast("timestamp"))
            columns.append(value.cast(field.dataType).alias(field.name))
        self.columns = columns
        self.spark.range(0).select(*columns).write.parquet(self.path)
        self.stream = stream.unionByName(self.spark.readStream.schema(stream.schema).parquet(self.path))

    def put(self) -> None:
        self.spark.range(1).select(*self.columns).write.mode("append").parquet(self.path)


class Carried:
    """A few values carried from micro-batch to micro-batch, in a small file a batch.

    The values for batch n are those saved by the newest batch before n, so running a batch again after a
    failure finds the same values. The two newest files are kept.
    """

    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names

    def _batches(self, spark: SparkSession) -> list[int]:
        return [int(n.split(".")[0]) for n in storage.names(spark, self.path) if not n.startswith(".")]

    def _file(self, batch_id: int) -> str:
        return f"{self.path}/{batch_id:012d}.json"

    def before(self, spark: SparkSession, batch_id: int) -> Row | None:
        earlier = [b for b in self._batches(spark) if b < batch_id]
        return Row(*self.names)(*json.loads(storage.read_text(spark, self._file(max(earlier))))) if earlier else None

    def save(self, spark: SparkSession, batch_id: int, values: tuple) -> None:
        storage.write_text(spark, self._file(batch_id), json.dumps(values))
        for old in sorted(self._batches(spark))[:-2]:
            storage.delete(spark, self._file(old))
