"""The file system behind a path as Spark reaches it (local, HDFS, object store): existence, names, small texts."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _open(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none for a folder that is not there."""
    fs, place = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def parquet_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the Parquet files in a folder, sorted."""
    return [n for n in names(spark, path) if n.endswith(".parquet")]


def date_by_name(spark: SparkSession, path: str) -> bool:
    """Give the Parquet files of a folder modification times in order of their names, a second apart and none later than
    now. False if the store does not keep such times."""
    fs, place = _open(spark, path)

    def times() -> dict[str, int]:
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(place)}

    found, was = parquet_files(spark, path), times()
    first = min((was[n] for n in found), default=0) - 1000 * len(found)
    for i, name in enumerate(found):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), first + 1000 * i, -1)
    now = times()
    return all(now[a] < now[b] for a, b in zip(found, found[1:]))


def sizes(spark: SparkSession, path: str) -> int:
    """Bytes below a path, 0 if it is not there."""
    fs, place = _open(spark, path)
    return fs.getContentSummary(place).getLength() if fs.exists(place) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _open(spark, path)
    fs.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that readers see whole or not at all: written under another name, then renamed."""
    folder, _, name = path.rpartition("/")
    fs, hidden = _open(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:8]}")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.rename(hidden, place) or fs.exists(hidden):  # a file of that name stands there: from an earlier attempt
        fs.delete(place, False)
        if not fs.rename(hidden, place):
            raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _open(spark, path)
    source = fs.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
