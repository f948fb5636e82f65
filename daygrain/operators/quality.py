"""Data-quality checks: each returns the rows that fail."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class StaleSnapshotError(RuntimeError):
    """No snapshot lies inside the allowed window."""


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; a NULL key never fails."""
    return df.groupBy(key).agg(F.count(key).alias("__n")).where(F.col("__n") > 1).select(key)


def not_numeric_non_negative(df: DataFrame, columns: Sequence[str], numeric: str = "decimal(18,3)") -> DataFrame:
    """Cast columns of rows where any of them is no number, missing or below zero."""
    casts = df.select(*[F.col(c).try_cast(numeric).alias(f"number_{c}") for c in columns])
    bad = reduce(lambda a, b: a | b, [(F.col(n) < 0) | F.col(n).isNull() for n in casts.columns])
    return casts.where(bad)


def require_empty(failures: DataFrame, what: str) -> None:
    """Raise with one example when a check found anything."""
    example = failures.take(1)
    if example:
        raise ValueError(f"{what} failed, for example: {example[0].asDict()}")
