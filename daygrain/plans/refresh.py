"""Tables by definition: what a plan's rows are checked for, and how they enter the stored table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators import quality
from daygrain.operators.consolidate import recompile
from daygrain.session import cut, temporary
from daygrain.sinks import tables
from daygrain.sources import files

FULL, TIME_RANGE, BY_KEY = "full", "time range", "by key"


@dataclass(frozen=True)
class Table:
    """``kind``: replaced as a whole, by the days of ``time``, or merged by ``key``.

    ``unique``: columns whose values may not repeat. ``numeric``: columns that must hold a number of
    zero or more.
    """

    name: str
    kind: str
    key: str | None = None
    time: str | None = None
    unique: tuple[str, ...] = ()
    numeric: tuple[str, ...] = field(default=())


# The tables kept, their kinds, and what is checked before a load counts.
DEFINED = [
    Table("raw_incidents", BY_KEY, key="objectid", unique=("objectid",)),
    Table("raw_historical_games", TIME_RANGE, time="game_date", numeric=("visiting_team_score", "home_team_score")),
    Table("stg_historical_games", TIME_RANGE, time="game_date", unique=("historical_game_id",)),
    Table("teams", FULL, unique=("team",)),
    Table("ballparks", FULL, unique=("park_id",)),
    Table("daily_weather", TIME_RANGE, time="report_date", unique=("report_date",)),
    Table("daily_rates", TIME_RANGE, time="dispatch_date", unique=("dispatch_date",)),
    Table("games", FULL),
]
TABLES: Mapping[str, Table] = {t.name: t for t in DEFINED}


def audit(rows: DataFrame, table: Table) -> None:
    """Raise with an example when a check of the table finds something."""
    for column in table.unique:
        quality.require_empty(quality.duplicate_keys(rows, column), f"{table.name}: {column} is unique")
    if table.numeric:
        quality.require_empty(quality.not_numeric_non_negative(rows, table.numeric), f"{table.name}: {', '.join(table.numeric)} are numbers from zero up")


def refresh(rows: DataFrame, table: Table, base: str, start: dt.date | None = None, end: dt.date | None = None) -> str:
    """Check ``rows`` and bring them into the table below ``base``; returns its folder.

    The rows are stored once, so that checks and writer see the same ones. Nothing is written when
    a check fails. Tables by time need the interval [start, end); old versions are dropped.
    """
    spark, target = rows.sparkSession, f"{base}/{table.name}"
    with temporary(spark):
        stored = cut(rows)
        audit(stored, table)
        if table.kind == TIME_RANGE:
            tables.write_time_range(stored, target, table.time, start, end)
        elif table.kind == BY_KEY:
            tables.upsert(stored, target, table.key)
        else:
            tables.write_full(stored, target)
    if table.kind != TIME_RANGE:
        tables.drop_old_versions(spark, target)
    return target


def recompile_year(spark: SparkSession, landing: str, base: str, cities: list[str], year: int) -> None:
    """Build the yearly observation sets of ``cities`` anew from all their landed daily files of ``year``.

    Files are named ``<city>_weather_report_metar_<date>.json`` and count in the order of their dates.
    """
    paths = [f"{landing}/{city}_weather_report_metar_{year}-*.json" for city in cities]
    rows = files.read_observation_arrays(spark, paths)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)_weather_report_metar_(\d{4}-\d{2}-\d{2})", 1)
    date = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)_weather_report_metar_(\d{4}-\d{2}-\d{2})", 2)
    with temporary(spark):
        stored = cut(rows.select("*", name.alias("city"), F.to_date(date).alias("file_date")))
        kept = recompile(stored, "file_date", "reportTime", ["city"]).drop("file_date")
        tables.write_yearly(kept.where(F.year("reportTime") == year), base)
