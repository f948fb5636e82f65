"""Merging daily observation files into yearly sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.session import once


def consolidate(
    existing: DataFrame | None, new: DataFrame, time: str = "reportTime", keys: Sequence[str] = (), begins: Column | None = None
) -> DataFrame:
    """Replace the tail: stored rows from the new batch's first instant on give way to the batch.

    Re-ingesting an old day thus removes everything later. ``keys`` keeps cities apart.
    An empty batch changes nothing. ``begins`` is the batch's first instant, if the caller knows it; else
    the batch is stored, as that is asked for before its rows.
    """
    if existing is None:
        return new
    if begins is not None and not keys:
        return new.unionByName(existing.where(F.col(time) < begins))
    new = once(new)
    earliest, some = F.min(time), F.count(F.lit(1)) > 0
    if keys:
        firsts = new.groupBy(*keys).agg(earliest.alias("__first"), some.alias("__some"))
        firsts = firsts.withColumnsRenamed({k: f"__of_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
        beside = existing.join(firsts, same, "left")
        kept = beside.where(~F.coalesce(F.col("__some"), F.lit(False)) | (F.col(time) < F.col("__first")))
    else:
        # As a subquery the instant is known before the scan and prunes it.
        kept = existing.where(new.agg(~some).scalar() | (F.col(time) < new.agg(earliest).scalar()))
    return new.unionByName(kept.select(*existing.columns))


def recompile(files: DataFrame, file_date: str, time: str = "reportTime", keys: Sequence[str] = ("city", "year")) -> DataFrame:
    """All daily files of a year at once, equal to consolidating them one by one in date order.

    A row survives if it lies before the first instant of every later file. Only one
    small row per file is ordered; adaptive execution joins the limits by their real size. The files
    are stored, as they are read for the limits and for the rows.
    """
    keys, files = list(keys), once(files)
    per_file = files.groupBy(*keys, file_date).agg(F.min(time).alias("__first"))
    later = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(file_date).rowsBetween(1, Window.unboundedFollowing)
    limits = per_file.select(
        *keys,
        file_date,
        F.min("__first").over(later).alias("__limit"),
        F.count(F.lit(1)).over(later).alias("__later"),
        F.count_if(F.col("__first").isNull()).over(later).alias("__undated"),
    ).withColumnsRenamed({k: f"__of_{k}" for k in [*keys, file_date]})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in [*keys, file_date]])
    survives = (F.col("__later") == 0) | ((F.col("__undated") == 0) & (F.col(time) < F.col("__limit")))
    return files.join(limits, same).where(survives).select(*files.columns)
