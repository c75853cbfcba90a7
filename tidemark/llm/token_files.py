"""Token ids in Arrow files of fixed-size-list batches.

A file holds sequences of one length as rows of two fixed-size lists, ids and mask,
so the ids of row i stand at i * length of one buffer: a memory map gives any
sequence without copying; the mask takes a bit an id. Files follow the order of the keys; the last row of each
is filled up and masked. Beside each file lies its index, an Arrow file as well, which says
where each document's ids are; a manifest names the finished files and how many ids come
before each. So a folder stands alone.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged, text_slices, unstage
from tidemark.llm.tokens import process_encoder, vocabulary_path
from tidemark.sources.scratch import local_rows, scratch_path

#: Sequences in a record batch.
BATCH_ROWS = 512


def file_schema(length: int, dtype: np.dtype) -> pa.Schema:
    item = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([
        pa.field("ids", pa.list_(pa.field("item", item, nullable=False), length), nullable=False),
        pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length), nullable=False),
    ])


def fixed_batch(flat: np.ndarray, filled: int, length: int, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of sequences from ids that already fill whole rows."""
    mask = np.zeros(len(flat), dtype=bool)
    mask[:filled] = True
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), schema, strict=True)]
    return pa.RecordBatch.from_arrays(lists, schema=schema)


class TokenWriter:
    """Writes chains of ids as one Arrow file; memory holds one batch."""

    def __init__(self, path: str, length: int, dtype: np.dtype, batch_rows: int = BATCH_ROWS):
        store, place = fs.FileSystem.from_uri(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.schema, self.length, self.dtype = file_schema(length, dtype), length, dtype
        self.out = store.open_output_stream(place)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.held, self.n_held, self.most = [], 0, length * batch_rows

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.most:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.most * self.most
            for i in range(0, whole, self.most):
                self.writer.write_batch(fixed_batch(flat[i : i + self.most], self.most, self.length, self.schema))
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            filled = len(flat)
            flat = np.concatenate([flat, np.zeros(-filled % self.length, dtype=self.dtype)])
            self.writer.write_batch(fixed_batch(flat, filled, self.length, self.schema))
        self.writer.close()
        self.out.close()


class TokenFile:
    """Random access to a file: sequence(i) and span(a, b) are views of the mapped file
    where it is local and they lie in one batch."""

    def __init__(self, path: str):
        store, place = fs.FileSystem.from_uri(path)
        source = pa.memory_map(place) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(place)
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.kept: tuple[int, np.ndarray, np.ndarray] | None = None
        first = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1
        self.per_batch = first * self.length  # every batch but the last has as many rows

    def _batch(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if self.kept is None or self.kept[0] != k:
            b = self.reader.get_batch(k)
            ids, mask = (b.column(i).flatten() for i in range(2))
            self.kept = (k, ids.to_numpy(zero_copy_only=True), np.frombuffer(mask.buffers()[1], dtype=np.uint8))
        return self.kept[1:]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        k, at = divmod(i * self.length, self.per_batch)
        ids, bits = self._batch(k)
        return ids[at : at + self.length], _unpacked(bits, at, at + self.length)

    def arrays(self, i: int) -> tuple[pa.Array, pa.Array]:
        """Ids and mask of a sequence as Arrow arrays over the file's own bytes, the mask as
        its bits: nothing is copied or unpacked."""
        k, at = divmod(i * self.length, self.per_batch)
        ids, mask = (self.reader.get_batch(k).column(j).flatten() for j in range(2))
        return ids.slice(at, self.length), mask.slice(at, self.length)

    def span(self, start: int, end: int) -> np.ndarray:
        parts = []
        while start < end:
            k, at = divmod(start, self.per_batch)
            ids, bits = self._batch(k)
            now = min(end - start, len(ids) - at)
            if now <= 0 or not _unpacked(bits, at, at + now).all():
                raise ValueError("the span goes beyond the file's ids")
            parts.append(ids[at : at + now])
            start += now
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint16)


def _unpacked(bits: np.ndarray, start: int, end: int) -> np.ndarray:
    """Mask from its packed bits, of which only those bytes are read."""
    return np.unpackbits(bits[start >> 3 : (end + 7) >> 3], bitorder="little")[start & 7 :][: end - start].astype(bool)


FILES = "part int, file string, n_docs long, n_tokens long"
INDEX = "part int, file string, at long, n_tokens long, start long"


class TableWriter:
    """Writes record batches of one schema, that of the first, as an Arrow file."""

    def __init__(self, path: str):
        store, place = fs.FileSystem.from_uri(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.out, self.writer = store.open_output_stream(place), None

    def add(self, batch: pa.RecordBatch) -> None:
        self.writer = self.writer or pa.ipc.new_file(self.out, batch.schema)
        self.writer.write_batch(batch)

    def close(self) -> None:
        if self.writer:
            self.writer.close()
        self.out.close()


def table_batches(path: str) -> Iterator[pa.RecordBatch]:
    """The record batches of an Arrow file, one at a time."""
    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_file(place) as source:
        reader = pa.ipc.open_file(source)
        for i in range(reader.num_record_batches):
            yield reader.get_batch(i)


def index_path(file: str) -> str:
    """Where the index of a file of ids lies."""
    return file.removesuffix(".arrow") + ".index.arrow"


def write_tokens(docs: DataFrame, folder: str, length: int = 2048, end_id: int = 2, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write all documents in ascending key order; returns the index as
    read_index() reads it from the folder.

    Null and empty texts are the end id alone. Rows of equal keys follow by their
    texts; null keys come first. An empty table writes a manifest without files. A task that
    is run again writes files of its own, and the manifest names only finished ones.
    """
    path = path or vocabulary_path()
    # Rows of one key are dealt by how their texts begin, so that no task gets all that lack a key.
    ranged = docs.select(key, text).repartitionByRange(F.col(key), F.left(F.col(text), F.lit(64))).sortWithinPartitions(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = process_encoder(path), TaskContext.get()
        ending = np.array([end_id], dtype=encoder.dtype)
        part, at, n_docs, writer, places = task.partitionId(), 0, 0, None, None
        name = f"{folder}/part-{part:06d}-{task.taskAttemptId()}.arrow"
        for batch in batches:
            for rows in text_slices(batch, 1):
                starts, counts = [], []
                writer, places = writer or TokenWriter(name, length, encoder.dtype), places or TableWriter(index_path(name))
                for raw in encoder.encode(rows.column(1).to_pylist()):
                    ids = np.concatenate([np.frombuffer(raw, dtype=encoder.dtype), ending])
                    writer.add(ids)
                    starts.append(at)
                    counts.append(len(ids))
                    at += len(ids)
                places.add(pa.RecordBatch.from_arrays([rows.column(0), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], names=["key", "at", "n_tokens"]))
                n_docs += rows.num_rows
        if writer:
            writer.close()
            places.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([n_docs], pa.int64()), pa.array([at], pa.int64())], names=["part", "file", "n_docs", "n_tokens"])

    made = staged(ranged.mapInArrow(run, FILES), "files")
    found = made.orderBy("part").toArrow()  # one row a file
    unstage(made)
    n = found.column("n_tokens").to_numpy()
    manifest = TableWriter(f"{folder}/manifest.arrow")
    held = found.append_column("start", pa.array(np.cumsum(n) - n, pa.int64()))
    held = held.replace_schema_metadata({"key": json.dumps(docs.schema[key].jsonValue())}).combine_chunks()
    for batch in held.to_batches() or [pa.RecordBatch.from_pylist([], schema=held.schema)]:
        manifest.add(batch)
    manifest.close()
    return read_index(docs.sparkSession, folder)


def read_index(spark: SparkSession, folder: str, checks: bool = False) -> DataFrame:
    """A row a document from the index files of a folder: its key (named as it was), part,
    file, at (ids before it in its file), n_tokens, start (ids before it in all). With checks, its ids
    are read back from their file too, and n_tokens (as read) is followed by ids_crc32. The driver
    reads the manifest alone, a row a file. The frame knows its folder."""
    held = pa.Table.from_batches(table_batches(f"{folder}/manifest.arrow"))
    own = T.StructField.fromJson(json.loads(held.schema.metadata[b"key"]))
    more = [T.StructField("ids_crc32", T.LongType())] if checks else []
    schema = T.StructType([T.StructField(own.name, own.dataType), *T.StructType.fromDDL(INDEX).fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for f in files.to_pylist():
                ids = TokenFile(f["file"]) if checks else None
                for rows in table_batches(index_path(f["file"])):
                    k, at, n = rows.num_rows, rows.column(1).to_numpy(), rows.column(2)
                    out = [rows.column(0), pa.array([f["part"]] * k, pa.int32()), pa.array([f["file"]] * k), rows.column(1), n, pa.array(at + f["start"], pa.int64())]
                    if checks:
                        read = [ids.span(a, a + m) for a, m in zip(at.tolist(), n.to_pylist(), strict=True)]
                        out[4] = pa.array(map(len, read), pa.int64())
                        out.append(pa.array((zlib.crc32(x.astype("<u4").tobytes()) for x in read), pa.int64()))
                    yield pa.RecordBatch.from_arrays(out, names=schema.names)

    files = list(zip(*(held.column(c).to_pylist() for c in ("part", "file", "start")), strict=True))
    found = local_rows(spark, files, "part int, file string, start long").mapInArrow(run, schema)
    found.folder = folder
    return found


def read_checks(index: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document's ids, read back from the files of the index's folder: key, start, n_tokens,
    ids_crc32. One map reads index and ids, so a task has one Python worker."""
    return read_index(index.sparkSession, index.folder, checks=True).select(key, "start", "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, **how) -> tuple[str, DataFrame]:
    """Write to a fresh shared folder; (folder, index)."""
    folder = scratch_path(docs.sparkSession, "tokens")
    if "://" not in folder:
        folder = folder.replace("file:", "file://") if folder.startswith("file:") else f"file://{folder}"
    return folder, write_tokens(docs, folder, **how)
