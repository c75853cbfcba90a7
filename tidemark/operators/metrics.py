"""Counts and job statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

def observed(df: DataFrame, name: str, *more: Column) -> tuple[DataFrame, Observation]:
    """The frame, and its row count (n) and further aggregates once it was written: no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *more), seen


def n_records(df: DataFrame | None) -> int:
    """Rows of a destination, 0 if it isn't there."""
    return 0 if df is None else df.count()


def estimated_megabytes(current: Column, changed: Column, total: Column, previous: Column) -> Column:
    """Megabytes of the whole table from those of the rows moved; if none were, as before."""
    return F.when(changed > 0, current / changed * total).otherwise(previous)


def latest_statistics(stats: DataFrame, job: str = "job_id", at: str = "start_time") -> DataFrame:
    """The last row of each job."""
    rest = [c for c in stats.columns if c != job]
    return stats.groupBy(job).agg(F.max_by(F.struct(*rest), at).alias("last")).select(job, "last.*")


def per_partition(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    return df.groupBy(*parts).agg(F.count(F.lit(1)).alias("n_updates"))
