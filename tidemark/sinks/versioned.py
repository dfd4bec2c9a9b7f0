"""A table of one row per key that micro-batches upsert into.

The rows lie in a snapshot and, on top of it, the changes of later batches. Which folders belong together is
said by one small version file a batch, written last and in one step: a reader sees a batch whole or not at all,
and goes on reading its version while newer ones come. Once the changes outgrow the snapshot, or
are many, the batch merges all into a new snapshot; folders that neither the newest version nor the one before
names are deleted. So the size is bounded by the number of keys, not of batches.

A batch that runs again after a failure starts from the version before its own and commits the same
version, which changes nothing. One writer (one streaming query) per table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import storage

MOST_CHANGES = 8  # folders of changes on top of a snapshot


class VersionedTable:
    """``keys`` identify a row; of several rows of a key the one with the greatest ``seq`` counts (of equal
    ones the greatest values). ``schema`` is that of the rows: keys, seq and values."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], seq: str, schema: str):
        self.spark, self.path, self.keys, self.seq, self.schema = spark, path.rstrip("/"), keys, seq, schema

    def versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in storage.names(self.spark, f"{self.path}/versions") if not n.startswith(".")]

    def _parts(self, before: int | None = None) -> list[dict]:
        """The folders of the newest version, or of the newest one before batch ``before``."""
        numbers = [v for v in self.versions() if before is None or v < before]
        return json.loads(storage.read_text(self.spark, self._version(max(numbers)))) if numbers else []

    def _version(self, batch: int) -> str:
        return f"{self.path}/versions/{batch:012d}.json"

    def read(self, before: int | None = None) -> DataFrame:
        """The rows as the newest batch, or the newest one before ``before``, left them."""
        return self._read(self._parts(before))

    def _read(self, parts: list[dict]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{p['name']}" for p in parts])
        return rows if len(parts) == 1 else self._newest(rows)

    def _newest(self, rows: DataFrame) -> DataFrame:
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        rest = [self.seq, *[c for c in names if c not in (*self.keys, self.seq)]]
        best = rows.groupBy(*self.keys).agg(F.max(F.struct(*rest)).alias("__n"))
        return best.select(*self.keys, *[f"__n.{c}" for c in rest]).select(*names)

    def merge(self, rows: DataFrame, batch: int, keep: Column | None = None) -> None:
        """Upsert ``rows`` as batch ``batch``. A new snapshot leaves out rows that do not pass ``keep``."""
        if batch in self.versions():
            return
        parts = self._parts(before=batch)
        parts = [*parts, self._write(self._newest(rows), f"changes-{batch}")]
        changes = parts[1:]
        if len(changes) > MOST_CHANGES or sum(p["rows"] for p in changes) > parts[0]["rows"]:
            whole = self._read(parts)
            parts = [self._write(whole if keep is None else whole.filter(keep), f"snapshot-{batch}")]
        storage.write_text(self.spark, self._version(batch), json.dumps(parts))
        self._clean()

    def _write(self, rows: DataFrame, name: str) -> dict:
        part = f"{name}-{uuid.uuid4().hex[:8]}"
        path = f"{self.path}/data/{part}"
        rows.write.parquet(path)
        return {"name": part, "rows": self.spark.read.schema(self.schema).parquet(path).count()}

    def _clean(self) -> None:
        kept = sorted(self.versions())[-2:]
        for version in self.versions():
            if version not in kept:
                storage.delete(self.spark, self._version(version))
        named = {p["name"] for v in kept for p in json.loads(storage.read_text(self.spark, self._version(v)))}
        for name in storage.names(self.spark, f"{self.path}/data"):
            if name not in named:
                storage.delete(self.spark, f"{self.path}/data/{name}")
