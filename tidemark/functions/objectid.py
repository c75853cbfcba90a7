"""Ids of 24 hexadecimal digits whose first eight are the seconds of their creation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def created_at(c: Column) -> Column:
    """Creation time, UTC."""
    seconds = F.conv(F.substring(c, 1, 8), 16, 10).cast("bigint")
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01").cast("timestamp_ntz"))


def least_id(seconds: Column) -> Column:
    """The smallest id of a second; ids compare as texts in order of creation."""
    return F.concat(F.lower(F.lpad(F.hex(seconds.cast("bigint")), 8, "0")), F.lit("0" * 16))


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 of a UTC time."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)


def before(c: Column, moment: Column) -> Column:
    """Whether an id was made before a moment (to the second)."""
    return c < least_id(epoch_seconds(moment))
