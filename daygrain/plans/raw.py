"""Raw tables: landed files -> declared columns, for an interval and an as-of date.

``landing`` is the root of the landing zone; city, interval and dates are arguments.
"""

from __future__ import annotations

import csv
import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions.columns import concat_strict, grouped_digits_to_long, in_range, without_text
from daygrain.sources import files, schemas, snapshots

# Layout of the landing zone, below its root.
STATION_REPORTS = "weather/{city}/ncei"
OBSERVATION_SETS = "weather/observations"
INCIDENT_REPORTS = "crime/{city}/{year}"
SCHEDULES = "baseball/current"
GAME_LOGS = "baseball/historical/gamelogs"
GAME_LOG_NAMES = "baseball/historical/columns/historical_baseball_headers.csv"
TEAMS = "baseball/historical/domain/teams.csv"
BALLPARKS = "baseball/historical/domain/ballparks.csv"
CENSUS = "population/us_census_bureau_pop_estimates_{years}.csv"


def observations(spark: SparkSession, landing: str, city: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return files.read_observations(spark, f"{landing}/{OBSERVATION_SETS}", city, start, end)


def station_days(spark: SparkSession, landing: str, city: str, start: dt.date, end: dt.date, as_of: dt.date) -> DataFrame:
    """Newest station report, all its files; raises when none is recent enough."""
    paths = snapshots.list_paths(spark, f"{landing}/{STATION_REPORTS.format(city=city)}", "*.csv")
    newest = snapshots.require_snapshot(paths, *snapshots.station_window(as_of))
    parts = [files.read_csv_after_preamble(spark, path, skip=1).toDF(*schemas.STATION_DAY_HEADER) for path in sorted(newest)]
    rows = reduce(DataFrame.unionByName, parts)
    rows = rows.withColumn("date", F.to_date("date", "yyyy-MM-dd"))
    return rows.where(in_range(F.col("date"), start, end))


def incidents(spark: SparkSession, landing: str, city: str, as_of: dt.date) -> DataFrame:
    """Reports of past years and the newest one of this year, in one read."""
    base = f"{landing}/{INCIDENT_REPORTS.format(city=city, year=as_of.year)}"
    paths = snapshots.list_paths(spark, base, "*.json")
    past = paths.where(F.col("path").contains("/past/"))
    current = snapshots.latest_snapshot(paths, *snapshots.incident_window(as_of), rf"/{as_of.year}/(\d{{4}}-\d{{2}}-\d{{2}})/")
    chosen = [row.path for row in past.unionByName(current.select("path")).collect()]
    if not chosen:
        return spark.createDataFrame([], schemas.INCIDENT).withColumn("dispatch_date", F.to_date("dispatch_date", "yyyy-MM-dd"))
    rows = files.read_envelope(spark, chosen, schemas.INCIDENT)
    return rows.withColumn("dispatch_date", F.to_date("dispatch_date", "yyyy-MM-dd"))


def current_games(spark: SparkSession, landing: str, start: dt.date, end: dt.date, as_of: dt.date) -> DataFrame:
    """Newest season schedule; raises when none is recent enough."""
    paths = snapshots.list_paths(spark, f"{landing}/{SCHEDULES}", "*.json")
    newest = snapshots.require_snapshot(paths, *snapshots.schedule_window(as_of))
    return files.read_schedule(spark, newest, start, end)


def historical_games(spark: SparkSession, landing: str, start: dt.date, end: dt.date) -> DataFrame:
    """Game logs of all years under the column names kept in a file of their own."""
    rows = files.read_csv_named_apart(spark, f"{landing}/{GAME_LOGS}", f"{landing}/{GAME_LOG_NAMES}")
    rows = rows.withColumn("game_date", F.to_date("game_date", "yyyyMMdd"))
    return rows.where(in_range(F.col("game_date"), start, end))


def teams(spark: SparkSession, landing: str) -> DataFrame:
    return files.read_csv_typed(spark, f"{landing}/{TEAMS}", schemas.TEAM)


def ballparks(spark: SparkSession, landing: str) -> DataFrame:
    return files.read_csv_typed(spark, f"{landing}/{BALLPARKS}", schemas.BALLPARK)


def years_to_rows(wide: DataFrame, area: str, years: dict[str, str]) -> DataFrame:
    """One column per year -> one row per area and year; ``years`` maps column to year text."""
    wide = wide.select(F.col(area).alias("geographic_area"), *[F.col(f"`{c}`").alias(y) for c, y in years.items()])
    return wide.unpivot("geographic_area", list(years.values()), "year_text", "population_text")


def population(parts: list[DataFrame]) -> DataFrame:
    """Long (area, year, population) from the per-decade long parts, as numbers."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    numbers = together.withColumns(
        {
            "year": without_text(F.col("year_text"), "POPESTIMATE").cast("bigint"),
            "population": grouped_digits_to_long(F.col("population_text")),
        }
    )
    return numbers.drop("year_text", "population_text").where(F.col("geographic_area").isNotNull())


def population_estimates(spark: SparkSession, landing: str) -> DataFrame:
    """Three census files: one with full names, two with titles above blank headers."""
    path = lambda years: f"{landing}/{CENSUS.format(years=years)}"
    names = next(csv.reader(files.first_lines(spark, path("2000-2009"), 1)))
    first = files.read_csv_text(spark, path("2000-2009"), names)
    first = first.withColumn("area", concat_strict(F.col("NAME"), ", ", F.col("STNAME")))
    second = files.read_csv_after_preamble(spark, path("2010-2019"), skip=3)
    third = files.read_csv_after_preamble(spark, path("2020-2024"), skip=4)
    return population(
        [
            years_to_rows(first, "area", {f"POPESTIMATE{y}": f"POPESTIMATE{y}" for y in range(2000, 2010)}),
            years_to_rows(second, "_duplicated_0", {str(y): str(y) for y in range(2010, 2020)}),
            years_to_rows(third, "_duplicated_0", {str(y): str(y) for y in range(2020, 2025)}),
        ]
    )
