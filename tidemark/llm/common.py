"""Helpers that the text operators share: staging tables and Arrow row maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.sources.scratch import remove, scratch_path

#: Rows handed to Python code at once; keeps a worker's memory near this many texts.
SLICE_ROWS = 256
#: Bytes of text handed at once to code that gains by many texts; a longer text goes alone.
SLICE_BYTES = 3 << 20


#: Paths staged since each open cleared() began.
_open: list[list[str]] = []


def staged(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and lost
    executors cost no recomputation. The frame knows its path."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", codec).parquet(path)
    for made in _open:
        made.append(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def unstage(df: DataFrame) -> None:
    """Remove the files of a staged frame that nothing reads any more."""
    remove(df.sparkSession, df.staged_at)
    for made in _open:
        if df.staged_at in made:
            made.remove(df.staged_at)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[list[str]]:
    """Remove what is staged inside when it ends, but for paths taken off the list. Only
    for work whose result is written inside: frames that are still lazy read those files."""
    _open.append(made := [])
    try:
        yield made
    finally:
        _open.remove(made)
        for path in made:
            remove(spark, path)


def text_slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts (in the column of that number) have about `most` bytes."""
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(), dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def map_slices(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]],
    schema: str | T.StructType,
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Run a function over slices of Arrow batches. make() runs once a task and
    returns the function, which maps a slice to columns of the schema (or its DDL)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        f = make()
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                cols = f(batch.slice(i, rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[x.name], type=x.type) for x in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def filter_slices(
    df: DataFrame,
    make: Callable[[], Callable[[list[str | None]], list[bool]]],
    text: str = "text",
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Keep the rows whose text the made function accepts; all columns pass through."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                yield part.filter(pa.array(f(part.column(at).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The rows of sorted batches by runs of equal values in the first n_keys columns. One
    run is held at a time."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys)), strict=True))
        at = 0
        for i, key in enumerate(keys):
            if key != last:
                if i > at:
                    kept.append(batch.slice(at, i - at))
                if kept:
                    yield pa.Table.from_batches(kept)
                kept, at, last = [], i, key
        if at < batch.num_rows:
            kept.append(batch.slice(at))
    if kept:
        yield pa.Table.from_batches(kept)
