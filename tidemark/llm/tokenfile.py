"""Token ids in Arrow files: fixed-size lists of ids and masks, readable without copying.

Documents are range-partitioned by id and encoded in order; every partition streams its ids into one
Arrow file of record batches. A row is one sequence of ``length`` tokens:

* ``ids``   fixed_size_list<uint16 or uint32>: the tokens, zero behind the last one of a file,
* ``mask``  fixed_size_list<bool>: whether the place holds a token,
* ``ends``  fixed_size_list<bool>: whether the token is a document's last one.

Sequence i of a file is at a fixed place (batch i // batch_rows, row i % batch_rows), so a memory map
gives it as a view. A second Arrow file beside it holds the documents' ids in the same order. Files
get a name of their own per attempt; only those named in the manifest count, so a task that is run
again, or twice at a time, does no harm.

Defined cases: a null text has only its end token; null document ids come first; rows with the same
id are ordered by text; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import table
from tidemark.llm.encode import DROPS_SPACE, Encoder
from tidemark.llm.queries import add
from tidemark.session import new_scratch

_MANIFEST = "part int, file string, docs_file string, n_docs bigint, n_tokens bigint"


def open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder given as a path or a URI."""
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pyarrow.fs.LocalFileSystem(), folder)


class _SequenceWriter:
    """Streams tokens into rows of ``length``."""

    def __init__(self, sink, dtype: str, length: int, batch_rows: int):
        self.length, self.room = length, length * batch_rows
        self.dtype = np.dtype(dtype)
        kind = pa.uint16() if self.dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)), ("ends", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids = np.zeros(self.room, dtype=self.dtype)
        self.ends = np.zeros(self.room, dtype=bool)
        self.used = 0

    def add(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.room - self.used)
            self.ids[self.used : self.used + n] = ids[at : at + n]
            self.used, at = self.used + n, at + n
            if at == len(ids):
                self.ends[self.used - 1] = True
            if self.used == self.room:
                self._write()

    def _write(self) -> None:
        rows = -(-self.used // self.length)
        mask = np.arange(rows * self.length) < self.used
        columns = [self.ids[: len(mask)], mask, self.ends[: len(mask)]]
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns]
        self.writer.write_batch(pa.record_batch(arrays, schema=self.schema))
        self.ids[:], self.ends[:], self.used = 0, False, 0

    def close(self) -> None:
        if self.used:
            self._write()
        self.writer.close()


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end: int, cut: str = DROPS_SPACE, length: int = 2048, batch_rows: int = 256
) -> list[dict]:
    """Encode ``docs(doc_id, text)`` in ascending id order into Arrow files under ``folder``.

    Returns the manifest in file order (as many entries as there are partitions)."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(tokenizer, cut)
        fs, root = open_folder(folder)
        writer = None
        n_docs = n_tokens = 0
        for part in parts:
            if writer is None:
                fs.create_dir(root, recursive=True)
                number = TaskContext.get().partitionId()
                name = f"tokens-{number:06d}-{uuid.uuid4().hex[:8]}"
                sink = fs.open_output_stream(posixpath.join(root, name + ".arrow"))
                docs_sink = fs.open_output_stream(posixpath.join(root, name + ".docs.arrow"))
                writer = _SequenceWriter(sink, encoder.dtype, length, batch_rows)
                docs_schema = pa.schema([("doc_id", pa.int64())])
                docs_writer = pa.ipc.new_file(docs_sink, docs_schema)
            for ids in encoder.encode(part["text"].tolist(), end):
                ids = np.frombuffer(ids, dtype=encoder.dtype)
                writer.add(ids)
                n_tokens += len(ids)
            numbers = pa.array(part["doc_id"].astype("Int64"), type=pa.int64(), from_pandas=True)
            docs_writer.write_batch(pa.record_batch([numbers], schema=docs_schema))
            n_docs += len(part)
        if writer is not None:
            for x in (writer, docs_writer, sink, docs_sink):
                x.close()
            row = (number, name + ".arrow", name + ".docs.arrow", n_docs, n_tokens)
            yield pd.DataFrame([row], columns=["part", "file", "docs_file", "n_docs", "n_tokens"])

    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInPandas(write, _MANIFEST).collect()
    manifest, before = [], 0
    for r in sorted(rows, key=lambda r: r["part"]):
        manifest.append(r.asDict() | {"start": before})
        before += r["n_tokens"]
    return manifest


def read_tokens(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """The documents of the files: ``(doc_id, start, n_tokens, ids)``, ids as little-endian uint32."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_folder(folder)
        for part in parts:
            for entry in part.itertuples():
                yield from _documents(fs, root, entry)

    rows = [(m["file"], m["docs_file"], m["start"]) for m in manifest]
    files = spark.createDataFrame(rows, "file string, docs_file string, start bigint")
    if rows:
        files = files.repartition(len(rows))
    return files.mapInPandas(read, schema)


def _documents(fs, root: str, entry) -> Iterator[pd.DataFrame]:
    local = isinstance(fs, pyarrow.fs.LocalFileSystem)

    def opened(name: str):
        path = posixpath.join(root, name)
        return pa.ipc.open_file(pa.memory_map(path) if local else fs.open_input_file(path))

    numbers = opened(entry.docs_file).read_all()["doc_id"].to_pylist()
    reader, at, start, rest = opened(entry.file), 0, entry.start, np.empty(0, dtype="<u4")
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        ids, mask, ends = (batch.column(k).values for k in range(3))
        used = int(pa.compute.sum(mask).as_py() or 0)
        tokens = ids.to_numpy()[:used].astype("<u4")
        stops = np.flatnonzero(ends.to_numpy(zero_copy_only=False)[:used]) + 1
        if not len(stops):
            rest = np.concatenate((rest, tokens))
            continue
        texts = np.split(tokens, stops)
        texts[0] = np.concatenate((rest, texts[0]))
        rest = texts.pop()
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        starts = start + np.concatenate(([0], np.cumsum(lengths)[:-1]))
        named = pd.array(numbers[at : at + len(texts)], dtype="Int64")
        yield pd.DataFrame({"doc_id": named, "start": starts, "n_tokens": lengths, "ids": [t.tobytes() for t in texts]})
        at, start = at + len(texts), start + int(lengths.sum())


def _op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place and checksum, read back from the Arrow files."""
    import public_tokenizers

    target = new_scratch(spark, "tokens")
    docs = table(spark, folder, "documents")
    manifest = write_tokens(docs, target, public_tokenizers.path("word_bpe_49k.json"), end=2)
    return read_tokens(spark, target, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


add("op2_token_files", _op2)
