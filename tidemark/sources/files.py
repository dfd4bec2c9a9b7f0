"""File sources: the Parquet tables, text lines, CSV tables declared in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import storage
from tidemark.session import new_scratch

TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event table with its time as TIMESTAMP ``ts`` and as microseconds ``us``."""
    return _timed(table(spark, folder, "events"))


# Slices of the recorded table that a stream gets one after another, a micro-batch each.
SLICES = 8
SLICE_FILE_BYTES = 64 << 20  # a slice is written, and read, in files of about this size,
SLICE_TASK_BYTES = 1 << 20  # or of less, down to this, so that every core has one
EVENT_TIME = "unix_micros(CAST(ts AS TIMESTAMP))"
FAR_FUTURE = "2200-01-01 00:00:00"
_recorded: dict[tuple, tuple[str, int]] = {}


def _record(spark: SparkSession, folder: str, slices: int, order: str) -> tuple[str, int]:
    """The event table as files in order of ``order`` (microseconds), written once per session: slice after slice, since
    a file stream takes files by their modification time. Returns the folder and files per slice."""
    key = (spark.sparkContext.applicationId, folder, slices, order)
    if key not in _recorded:
        timed, path = table(spark, folder, "events"), new_scratch(spark, "recorded")
        size = storage.sizes(spark, f"{folder}/events.parquet")
        cores = spark.sparkContext.defaultParallelism
        files = max(1, -(-size // (slices * SLICE_FILE_BYTES)), min(cores, size // (slices * SLICE_TASK_BYTES)))
        second = F.floor(F.expr(order) / 1_000_000).cast("bigint")
        shares = [i / slices for i in range(1, slices)]
        low, cuts = timed.agg(F.min(second), F.percentile_approx(second, shares)).first()
        cuts = sorted({c for c in cuts or [] if c > low})
        number = sum(((second >= c).cast("int") for c in cuts), F.lit(0))
        rows = timed if low is None else timed.filter(second.isNotNull())
        written = _deal(rows, number, len(cuts) + 1, files, path)
        if files > 1 and written < files * (len(cuts) + 1):  # a slice with too few rows for its files: one file each
            storage.delete(spark, path)
            files = 1
            _deal(rows, number, len(cuts) + 1, files, path)
        if not storage.date_by_name(spark, path):
            path = _in_turn(spark, path, files, timed.schema)
        _recorded[key] = (path, files)
    return _recorded[key]


def _deal(rows: DataFrame, number: Column, slices: int, files: int, path: str) -> int:
    """Write rows by the number of their slice, each slice in so many files, named in order of the slices; the number of
    files, fewer where one would be empty."""
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(files)).cast("int")
    rows.repartitionById(slices * files, number * files + share).write.parquet(path)
    return len(storage.parquet_files(rows.sparkSession, path))


def _in_turn(spark: SparkSession, path: str, files: int, schema: T.StructType) -> str:
    """The same files written again one slice after the other, for a store that keeps its own times."""
    found, again = storage.parquet_files(spark, path), new_scratch(spark, "recorded")
    for i in range(0, len(found), files):
        part = spark.read.schema(schema).parquet(*[f"{path}/{name}" for name in found[i : i + files]])
        part.repartition(files).write.mode("append").parquet(again)
    storage.delete(spark, path)
    return again


def events_stream(
    spark: SparkSession, folder: str, slices: int = SLICES, order: str = EVENT_TIME, end: dict[str, object] | None = None
) -> DataFrame:
    """The same table as a stream, replayed in order of time, or another order, in ``slices`` micro-batches, so that no
    row is late and the watermark moves while rows still come. With ``end`` (values of columns) one row far in the future
    comes after all others, in a micro-batch of its own, and closes every window before it."""
    path, files = _record(spark, folder, slices, order)
    schema = table(spark, folder, "events").schema
    if end is not None:
        last = new_scratch(spark, "end")
        values = {"ts": FAR_FUTURE, **end}
        row = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
        spark.range(1).select(*row).write.parquet(last)
        root, _, name = path.rpartition("/")
        path = f"{root}/{{{name},{last.rpartition('/')[2]}}}"
    return _timed(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path))


def _timed(df: DataFrame) -> DataFrame:
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df.withColumn("us", F.unix_micros("ts"))


def item() -> Column:
    """The item id inside the JSON properties of an event."""
    return F.get_json_object("props", "$.k").cast("bigint")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def text_lines_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TEXT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def json_lines_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


DECLARED = "tidemark.declared"


def declare_table(spark: SparkSession, name: str, columns: str, fmt: str, path: str, **options: str) -> DataFrame:
    """``CREATE TABLE name (columns) USING fmt`` over files at ``path``. An earlier declaration made here is replaced;
    a table of that name that somebody else made is not touched."""
    extra = "".join(f", '{k}' '{v}'" for k, v in options.items())
    if spark.catalog.tableExists(name):
        properties = {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if DECLARED not in properties:
            raise ValueError(f"there is a table {name} already")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} OPTIONS ('path' '{path}'{extra}) TBLPROPERTIES ('{DECLARED}' = 'yes')")
    return spark.table(name)
