"""Source against destination, row by row and column by column."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.change import MOST_RANGES, RANGE_KEYS, free_name, key_range, ranges_apart
from tidemark.operators.select import earlier
from tidemark.sources.scratch import local_rows


def sampled(df: DataFrame, key: str, of: int, take: int = 1) -> DataFrame:
    """A repeatable sample by a digest of the key: take parts of `of`; no sort, and the
    same rows on either side, whatever system draws them."""
    return df.where(F.md5(F.col(key).cast("string").cast("binary")) < f"{(take << 32) // of:08x}")


def due(key: Column, bookmark: Column | None, last_key: Any, last_run: Any, lag: int = 0) -> Column:
    """Rows that a run must have moved: keys up to the last one, bookmarks before the last
    run less the lag; a null bookmark stays."""
    moved = key <= F.lit(last_key)
    return moved if bookmark is None else moved & (bookmark.isNull() | (bookmark < earlier(last_run, lag)))


def matches(source: Column, dest: Column, kind: T.DataType, seconds: int = 0) -> Column:
    """Whether a destination value stands for a source value: falsy source values are not
    compared, times fit to the second (or within `seconds`), fractions to the whole number."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        trunc = lambda c: F.date_trunc("second", c)
        same = F.abs(F.timestamp_diff("MICROSECOND", source, dest)) <= seconds * 1_000_000 if seconds else trunc(source) == trunc(dest)
        empty = source.isNull()
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        same, empty = source.try_cast("bigint") == dest.try_cast("bigint"), source.isNull() | (source == 0)
    elif isinstance(kind, T.NumericType):
        same, empty = source == dest, source.isNull() | (source == 0)
    elif isinstance(kind, T.BooleanType):
        same, empty = source == dest, source.isNull() | ~source
    else:
        same, empty = source.cast("string") == dest.cast("string"), source.isNull() | (source.cast("string") == "")
    return empty | F.coalesce(same, F.lit(False))


def compare(source: DataFrame, dest: DataFrame, key: str, columns: Sequence[str] | None = None, seconds: int = 0) -> DataFrame:
    """(key, status, wrong): per key of either side, 'ok', 'mismatch', 'missing' (not in the
    destination) or 'extra', and the names of the columns that differ. Partition columns
    are left out."""
    columns = [c for c in columns or source.columns if c != key and not c.startswith("parquet_format")]
    a = source.select(F.col(key).alias("_key"), F.struct(*columns).alias("a"))
    b = dest.select(F.col(key).alias("_key"), F.struct(*columns).alias("b"))
    wrong = F.array_compact(F.array(*[F.when(~matches(F.col(f"a.{c}"), F.col(f"b.{c}"), source.schema[c].dataType, seconds), F.lit(c)) for c in columns]))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.size("wrong") > 0, "mismatch").otherwise("ok")
    none = F.array().cast("array<string>")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return a.join(b, "_key", "full").withColumn("wrong", F.when(both, wrong).otherwise(none)).select(F.col("_key").alias(key), status.alias("status"), "wrong")


def canonical(c: Column, kind: T.DataType, side: str, seconds: int = 0) -> Column:
    """A value as text, such that equal texts of both sides always match: times to the second, fractions to
    the whole number. A value that has no such form differs from any of the other side."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        shown = (c if seconds else F.date_trunc("second", c)).cast("timestamp_ntz")
    else:
        shown = c.try_cast("bigint") if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)) else c
    return F.when(c.isNull(), "").otherwise(F.coalesce(F.concat(F.lit("="), shown.cast("string")), F.lit(side)))


def compare_tree(source: DataFrame, dest: DataFrame, key: str, columns: Sequence[str] | None = None, seconds: int = 0, leaves: int | None = None) -> DataFrame:
    """The rows of compare(), for keys that a side holds once. Both sides are summed up by
    ranges of their keys' hashes, in one aggregation; only ranges that differ are joined column by
    column, so tables that are equal are compared without a join. leaves: how many ranges; by
    default one for RANGE_KEYS rows, MOST_RANGES at most, which bounds what the driver sees."""
    spark = source.sparkSession
    own = [c for c in columns or source.columns if c != key and not c.startswith("parquet_format")]
    leaves = leaves or min(MOST_RANGES, max(16, source.count() // RANGE_KEYS))

    def summed(df: DataFrame, side: str) -> DataFrame:
        row = F.xxhash64(F.col(f"`{key}`").cast("string"), *[canonical(F.col(f"`{c}`"), source.schema[c].dataType, side, seconds) for c in own])
        return df.select(key_range(key, leaves).alias("range"), F.when(F.col(f"`{key}`").isNotNull(), row).alias("h"))  # null keys match none

    apart = ranges_apart(summed(source, "source"), summed(dest, "dest"))
    shown = [F.col(f"`{key}`"), F.lit("ok").alias("status"), F.array().cast("array<string>").alias("wrong")]
    if not apart:
        return source.select(*shown)
    if len(apart) == leaves:
        return compare(source, dest, key, own, seconds)
    at = free_name([*source.columns, *dest.columns], "range")
    ranges = F.broadcast(local_rows(spark, [(r,) for r in apart], "range long").withColumnRenamed("range", at))
    part = lambda df, how: df.withColumn(at, key_range(key, leaves)).join(ranges, at, how).drop(at)
    return part(source, "left_anti").select(*shown).unionByName(compare(part(source, "left_semi"), part(dest, "left_semi"), key, own, seconds))


def summary(compared: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, mismatching rows (a missing row is one), and each column's count."""
    counts = [F.count_if(F.array_contains("wrong", c)).alias(f"wrong_{c}") for c in columns]
    return compared.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("status").isin("mismatch", "missing")).alias("n_mismatches"),
        F.count_if(F.col("status") == "missing").alias("n_missing"),
        F.count_if(F.col("status") == "extra").alias("n_extra"),
        *counts,
    )
