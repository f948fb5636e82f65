"""Choosing among dated files by the dates in their names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators.quality import StaleSnapshotError

DATE_IN_PATH = r"(\d{4}-\d{2}-\d{2})"


def list_paths(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """Names of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return files.load(base).select("path")


def dated_paths(paths: DataFrame, pattern: str = DATE_IN_PATH) -> DataFrame:
    """(path, snapshot_date) of the paths that carry a date."""
    stamped = F.try_to_date(F.regexp_extract("path", pattern, 1), "yyyy-MM-dd")
    return paths.select("path", stamped.alias("snapshot_date")).where(F.col("snapshot_date").isNotNull())


def latest_snapshot(paths: DataFrame, oldest: dt.date, newest: dt.date, pattern: str = DATE_IN_PATH) -> DataFrame:
    """Paths of the newest snapshot dated within [oldest, newest]; empty if there is none."""
    inside = dated_paths(paths, pattern).where(F.col("snapshot_date").between(F.lit(oldest), F.lit(newest)))
    return inside.where(F.col("snapshot_date") == inside.agg(F.max("snapshot_date")).scalar())


def snapshot_freshness(paths: DataFrame, oldest: dt.date, newest: dt.date, pattern: str = DATE_IN_PATH) -> DataFrame:
    """One row: the newest usable snapshot date and whether none was found."""
    inside = dated_paths(paths, pattern).where(F.col("snapshot_date").between(F.lit(oldest), F.lit(newest)))
    return inside.agg(F.max("snapshot_date").alias("snapshot_date")).withColumn("is_stale", F.col("snapshot_date").isNull())


def station_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Daily station reports: tomorrow back to 29 days ago."""
    return as_of - dt.timedelta(days=29), as_of + dt.timedelta(days=1)


def schedule_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Season schedules: today back to 30 days ago."""
    return as_of - dt.timedelta(days=30), as_of


def incident_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Incident reports: three days ahead back to 1 January, within the year of ``as_of``."""
    ahead = min(as_of + dt.timedelta(days=3), dt.date(as_of.year, 12, 31))
    return dt.date(as_of.year, 1, 1), ahead


def require_snapshot(paths: DataFrame, oldest: dt.date, newest: dt.date, pattern: str = DATE_IN_PATH) -> list[str]:
    """The newest snapshot's file names; raises when the window holds none."""
    chosen = [row.path for row in latest_snapshot(paths, oldest, newest, pattern).collect()]
    if not chosen:
        raise StaleSnapshotError(f"no snapshot between {oldest} and {newest}: ingest again")
    return chosen


def greatest_stamp(names: DataFrame, column: str = "path") -> DataFrame:
    """Names containing the greatest date stamp of the form ``…_YYYY-MM-DD.ext``.

    Folders are left out and names without a readable stamp never set the date.
    """
    named = names.where(~F.col(column).endswith("/"))
    last = F.element_at(F.split(column, "_"), -1)
    pieces = F.split(last, r"\.")
    stamp = F.when(F.col(column).contains("_") & (F.size(pieces) == 2), F.try_to_date(pieces[0], "yyyy-MM-dd"))
    greatest = named.agg(F.date_format(F.max(stamp), "yyyy-MM-dd")).scalar()
    return named.where(F.contains(F.col(column), greatest))
