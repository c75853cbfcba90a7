"""Folders that driver and executors share, and the small files in them that the driver
reads and writes by the file system itself, without a job."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session on one machine may do without
    it and gets a temporary one; elsewhere executors would not see each other's files."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        told = spark.sparkContext.getCheckpointDir()
    return told.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{tag}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it isn't there."""
    store, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def megabytes(spark: SparkSession, path: str) -> float:
    """What the files of a folder take, 0 if it isn't there."""
    store, where = _at(spark, path)
    return store.getContentSummary(where).getLength() / 1e6 if store.exists(where) else 0.0


def n_files(spark: SparkSession, path: str) -> int:
    store, where = _at(spark, path)
    return store.getContentSummary(where).getFileCount()


def remove(spark: SparkSession, path: str) -> None:
    store, where = _at(spark, path)
    store.delete(where, True)


def local_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str) -> DataFrame:
    """A few rows of the driver as a local relation: filters and projections of it need no job."""
    kinds = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), type=k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds))


def read_text(spark: SparkSession, path: str) -> str:
    store, where = _at(spark, path)
    stream = store.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new file, whole as soon as it can be seen; False if there is one of that name
    already. Of several writers one gets it: by a hard link on a local disk, by a rename
    that doesn't overwrite elsewhere."""
    store, where = _at(spark, path)
    aside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    _, temporary = _at(spark, aside)
    stream = store.create(temporary, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if store.getScheme() == "file":
            os.link(*(re.sub("^file:(//)?", "", p) for p in (aside, path)))
            return True
        jvm = spark.sparkContext._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files.rename(temporary, where, none)
        return True
    except FileExistsError:
        return False
    except Exception:
        if store.exists(where):
            return False
        raise
    finally:
        store.delete(temporary, False)
