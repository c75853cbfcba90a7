"""Projections: masks, names, record keys, snapshot stamps, partition columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.objectid import created_at

RECORD_KEY = "unique_migration_record_id"
SNAPSHOT = "migration_snapshot_date"
PARTITION = "parquet_format_"


def mask_text(c: Column, n: int) -> Column:
    """The last n characters as X; null counts as empty; n 0 changes nothing else."""
    text = F.coalesce(c, F.lit(""))
    return F.concat(F.left(text, F.greatest(F.char_length(text) - n, F.lit(0))), F.repeat(F.lit("X"), F.lit(n)))


def mask_digits(c: Column, n: int) -> Column:
    """The last n decimal digits as zero, towards minus infinity; null counts as 0."""
    x = F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    return x - F.pmod(x, F.lit(10**n).cast("bigint"))


def veil(c: Column, kind: T.DataType, n: int) -> Column:
    """A text or a whole number masked; other types are refused."""
    if isinstance(kind, T.StringType):
        return mask_text(c, n)
    if isinstance(kind, T.IntegralType):
        return mask_digits(c, n)
    raise TypeError(f"no mask for {kind.simpleString()}")


def masked(df: DataFrame, masks: Iterable[tuple[str, int]]) -> DataFrame:
    """Mask text and whole-number columns in place; other types are refused."""
    return df.withColumns({c: veil(F.col(f"`{c}`"), df.schema[c].dataType, n) for c, n in masks})


def renamed(df: DataFrame, names: Mapping[str, str], limits: Mapping[str, int] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Columns and what is known of their lengths under their new names."""
    return df.withColumnsRenamed(dict(names)), {names.get(k, k): v for k, v in (limits or {}).items()}


def with_record_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(RECORD_KEY, F.col(f"`{key}`").cast("string"))


def with_snapshot(df: DataFrame, run_at: Column) -> DataFrame:
    return df.withColumn(SNAPSHOT, run_at)


def partition_columns(df: DataFrame, parts: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """Add partition columns: of a datetime, or of the creation time in an object id
    ('objectid'), its year, month and day; of a text, int (null: 0) or float the value.
    Returns the frame and the names in order."""
    out: dict[str, Column] = {}
    for c, kind in parts.items():
        col, name = F.col(f"`{c}`"), f"{PARTITION}{c}"
        if kind in ("datetime", "objectid"):
            col = created_at(col) if kind == "objectid" else col
            out |= {f"{name}_year": F.year(col).cast("bigint"), f"{name}_month": F.month(col).cast("bigint"), f"{name}_day": F.dayofmonth(col).cast("bigint")}
        elif kind == "int":
            out[name] = F.coalesce(col.cast("bigint"), F.lit(0).cast("bigint"))
        elif kind == "float":
            out[name] = col.cast("double")
        else:
            out[name] = col.cast("string")
    return df.withColumns(out), list(out)


def month_of(c: Column) -> Column:
    """First moment of the month: the partition of a table kept by months."""
    return F.date_trunc("month", c).cast("timestamp_ntz")


def surrogate_key(*parts: Column) -> Column:
    """A key from where a record came from: the same when its task runs again."""
    return F.sha2(F.concat_ws("\x1f", *[p.cast("string") for p in parts]), 256)


def joined_key(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def overlong(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """(column_name, n_rows, longest) of text columns that hold more than their limit."""
    known = [(c, n) for c, n in limits.items() if c in df.columns]
    if not known:
        raise ValueError("no limited column")
    one = df.agg(*[F.struct(F.count_if(F.char_length(c) > n).alias("n"), F.max(F.char_length(c)).alias("most")).alias(c) for c, n in known])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c)["n"].alias("n_rows"), F.coalesce(F.col(c)["most"], F.lit(0)).cast("bigint").alias("longest")) for c, _ in known]))
    return one.select(rows.alias("x")).select("x.*").where("n_rows > 0")


def fitted(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Text columns cut to their limits."""
    return df.withColumns({c: F.left(F.col(c), F.lit(n)) for c, n in limits.items() if c in df.columns})


def lower_names(df: DataFrame) -> DataFrame:
    """Column names in lower case, sorted; names that meet are refused."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("two columns have the same name in lower case")
    return df.toDF(*names).select(*sorted(names))


def table_path(base: str, kind: str, database: str, table: str, suffix: str = "") -> str:
    """Where a table stands: dots and dashes in names are underscores."""
    clean = lambda s: re.sub(r"[.-]", "_", s)
    return f"{base.rstrip('/')}/{kind}/{clean(database)}/{clean(table)}{suffix}"
