"""Incremental selection: predicates that pick what a run has to move."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bookmark from which a first run counts.
EPOCH = "1999-01-01 00:00:00"


@dataclass(frozen=True)
class Watermark:
    """What earlier runs left behind. Times are UTC texts or datetimes."""

    last_run: Any = EPOCH
    last_key: Any = None
    recovery_key: Any = None
    recovery_time: Any = None


def literal(value: Any, like: Column | None = None) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def moment(value: Any) -> Column:
    """A time, given as a column, a datetime or a text, without a zone."""
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp_ntz")


def earlier(value: Any, seconds: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(-seconds), moment(value))


def high_water(df: DataFrame, key: str) -> Any:
    """The largest key of the source, null if it is empty."""
    return df.agg(F.max(key)).first()[0]


def new_rows(key: Column, last: Any, current: Any = None) -> Column:
    """Keys after the last one moved, up to the current largest if one is given; on a first
    run there is no lower bound. Null keys are no new ones."""
    upper = key.isNotNull() if current is None else key <= literal(current)
    return upper if last is None else (key > literal(last)) & upper


def bookmarked(bookmark: Column, after: Column, upto: Column | None = None, null_bookmark: str = "drop") -> Column:
    """Rows whose bookmark lies after a time (and not after another); a null bookmark
    counts as told: 'drop' or 'keep'."""
    fits = bookmark > after
    if upto is not None:
        fits = fits & (bookmark <= upto)
    return F.coalesce(fits, F.lit(False)) if null_bookmark == "drop" else bookmark.isNull() | fits


def updated_rows(key: Column, bookmark: Column, mark: Watermark, grace: int = 0, run_at: Any = None, null_bookmark: str = "drop") -> Column:
    """Rows moved before whose bookmark is later than the last run less a grace period in
    seconds."""
    if mark.last_key is None:
        return F.lit(False)
    upto = None if run_at is None else moment(run_at)
    return (key <= literal(mark.last_key)) & bookmarked(bookmark, earlier(mark.last_run, grace), upto, null_bookmark)


def recovered_rows(key: Column, bookmark: Column, mark: Watermark) -> Column:
    """Rows that a failed run had inserted and that changed since it began."""
    if mark.recovery_key is None:
        return F.lit(False)
    lower = F.lit(True) if mark.last_key is None else key > literal(mark.last_key)
    return lower & (key <= literal(mark.recovery_key)) & bookmarked(bookmark, moment(mark.recovery_time))


def buffered_rows(key: Column, bookmark: Column, run_at: Any, lag: int, moved: Any) -> Column:
    """Rows up to the last key moved whose bookmark lies in the last `lag` seconds before
    the run: they may have changed while it read."""
    return (key <= literal(moved)) & bookmarked(bookmark, earlier(run_at, lag), moment(run_at))


def update_set(key: Column, bookmark: Column, mark: Watermark, run_at: Any, grace: int = 0, lag: int = 0, moved: Any = None, null_bookmark: str = "drop") -> Column:
    """All rows to update, in one predicate for one scan."""
    found = updated_rows(key, bookmark, mark, grace, None, null_bookmark) | recovered_rows(key, bookmark, mark)
    return found if not lag or moved is None else found | buffered_rows(key, bookmark, run_at, lag, moved)
