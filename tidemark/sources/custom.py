"""Sources written in Python with Spark's Data Source API.

``RecordedEvents`` replays recorded rows. Its files are cut into pieces of ``pieceBytes``, from their sizes alone; a
task reads the row groups that begin in its piece, so the driver opens no file, however many there are.

* Batch: a task per piece. With ``subtasks`` = p there are p partitions, and subtask k reads every p-th piece, from the
  k-th on: each row once. With ``copies`` = c every subtask is there c times, each reading the same rows. Column
  ``subtask`` (``copy`` times p + k) tells which one a row came from.
* Stream: ``piecesPerBatch`` pieces per micro-batch. An offset names a file and a piece of it, so a restarted query
  reads the same rows although files have come since; new files are seen if their names sort behind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

PIECE_BYTES = 64 << 20


@dataclass(frozen=True, order=True)
class Piece:
    path: str
    number: int
    begin: int
    end: int


@dataclass
class Share(InputPartition):
    pieces: list[Piece]
    subtask: int


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def pieces_of(uri: str, piece_bytes: int) -> list[Piece]:
    """The pieces of a file, or of the Parquet files of a folder, in order of name and place."""
    from pyarrow import fs

    filesystem, path = _filesystem(uri)
    found = filesystem.get_file_info(path)
    if found.type == fs.FileType.Directory:
        found = [f for f in filesystem.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file]
        found = [f for f in found if not f.base_name.startswith(("_", ".")) and f.base_name.endswith(".parquet")]
    else:
        found = [found]
    return [
        Piece(f.path, i, i * piece_bytes, (i + 1) * piece_bytes)
        for f in sorted(found, key=lambda f: f.path)
        for i in range(max(1, -(-f.size // piece_bytes)))
    ]


def _read(uri: str, share: Share, columns: list[str]) -> Iterator:
    """The row groups of a share that begin in its pieces."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    filesystem, _ = _filesystem(uri)
    stored = [c for c in columns if c != "subtask"]
    for piece in share.pieces:
        with filesystem.open_input_file(piece.path) as source:
            file = pq.ParquetFile(source)
            meta = [file.metadata.row_group(g).column(0) for g in range(file.metadata.num_row_groups)]
            begins = [m.dictionary_page_offset or m.data_page_offset for m in meta]
            groups = [g for g, b in enumerate(begins) if piece.begin <= b < piece.end]
            for batch in file.iter_batches(row_groups=groups, columns=stored) if groups else ():
                named = dict(zip(batch.schema.names, batch.columns))
                named["subtask"] = pa.array([share.subtask] * batch.num_rows, pa.int32())
                arrays = [named[c].cast(pa.timestamp("us")) if pa.types.is_timestamp(named[c].type) else named[c] for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)


class _BatchReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], piece_bytes: int, subtasks: int, copies: int):
        self.path, self.columns, self.piece_bytes, self.subtasks, self.copies = path, columns, piece_bytes, subtasks, copies

    def partitions(self) -> list[Share]:
        found = pieces_of(self.path, self.piece_bytes)
        p = self.subtasks or len(found)
        return [Share(found[k::p], c * p + k) for c in range(self.copies) for k in range(p)]

    def read(self, partition: Share) -> Iterator:
        return _read(self.path, partition, self.columns)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, columns: list[str], piece_bytes: int, per_batch: int):
        self.path, self.columns, self.piece_bytes, self.per_batch = path, columns, piece_bytes, per_batch
        self.sent = ("", -1)

    def _between(self, after: tuple[str, int], upto: tuple[str, int] | None = None) -> list[Piece]:
        found = [(p.path, p.number, p) for p in pieces_of(self.path, self.piece_bytes)]
        return [p for path, n, p in found if after < (path, n) and (upto is None or (path, n) <= upto)]

    @staticmethod
    def _place(offset: dict) -> tuple[str, int]:
        return offset["file"], offset["piece"]

    def initialOffset(self) -> dict:
        return {"file": "", "piece": -1}

    def latestOffset(self) -> dict:
        ahead = self._between(self.sent)[: self.per_batch]
        if ahead:
            self.sent = (ahead[-1].path, ahead[-1].number)
        return {"file": self.sent[0], "piece": self.sent[1]}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        self.sent = max(self.sent, self._place(end))
        return [Share([p], 0) for p in self._between(self._place(start), self._place(end))]

    def read(self, partition: Share) -> Iterator:
        return _read(self.path, partition, self.columns)

    def commit(self, end: dict) -> None:
        pass


class RecordedEvents(DataSource):
    """``spark.read.format("recorded_events").option("path", ...)``; also readStream."""

    @classmethod
    def name(cls) -> str:
        return "recorded_events"

    def schema(self) -> str:
        return "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string, subtask int"

    def _number(self, name: str, default: int) -> int:
        return int(self.options.get(name, default))

    def reader(self, schema) -> _BatchReader:
        columns = [f.name for f in schema.fields]
        piece_bytes = self._number("pieceBytes", PIECE_BYTES)
        return _BatchReader(self.options["path"], columns, piece_bytes, self._number("subtasks", 0), self._number("copies", 1))

    def streamReader(self, schema) -> _StreamReader:
        columns = [f.name for f in schema.fields]
        return _StreamReader(self.options["path"], columns, self._number("pieceBytes", PIECE_BYTES), self._number("piecesPerBatch", 1))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordedEvents)
