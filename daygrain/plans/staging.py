"""Staged tables: renamed, typed and filtered raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.columns import concat_present, fahrenheit, flag, hours_earlier
from daygrain.operators.ordered import greatest_per_key


def observations(raw: DataFrame, daylight_hours: int = 4, standard_hours: int = 5) -> DataFrame:
    """Instants in UTC and at two fixed offsets, temperatures in both scales."""
    return raw.select(
        F.col("reportTime").alias("report_time_utc"),
        hours_earlier(F.col("reportTime"), daylight_hours).alias("report_time_edt"),
        hours_earlier(F.col("reportTime"), standard_hours).alias("report_time_est"),
        F.col("temp").alias("temp_deg_c"),
        fahrenheit(F.col("temp")).alias("temp_deg_f"),
        F.col("pcp6hr").alias("precip_last_6hrs_inches"),
        F.col("pcp24hr").alias("precip_last_24hrs_inches"),
    )


def station_days(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("date").alias("report_date"),
        F.col("`tavg (degrees fahrenheit)`").alias("avg_temp_deg_f"),
        F.col("`tmax (degrees fahrenheit)`").alias("max_temp_deg_f"),
        F.col("`tmin (degrees fahrenheit)`").alias("min_temp_deg_f"),
        F.col("`prcp (inches)`").alias("total_precip_inches"),
    )


def incidents(raw: DataFrame) -> DataFrame:
    day = F.col("dispatch_date")
    return raw.select(
        F.col("dc_key").alias("id"),
        day,
        F.year(day).cast("bigint").alias("dispatch_year"),
        F.month(day).cast("bigint").alias("dispatch_month"),
        F.dayofmonth(day).cast("bigint").alias("dispatch_day"),
        F.col("text_general_code").alias("incident_type"),
    )


def current_games(raw: DataFrame, finished: str = "F") -> DataFrame:
    side = lambda s: [f"{s}_team_{c}" for c in ("name", "score", "record_wins", "record_losses")]
    return raw.where(F.col("coded_game_state") == finished).select(
        F.col("date").alias("game_date"),
        F.col("game_pk").alias("game_id"),
        F.col("season").try_cast("int").alias("season"),
        *side("away"),
        *side("home"),
        "home_team_is_winner",
        flag(F.col("day_night") == "night").alias("night_game"),
        "is_tie",
        "series_game_number",
    )


def historical_games(raw: DataFrame) -> DataFrame:
    """Text columns to numbers (strictly), a readable game id, and result flags."""
    typed = raw.withColumns(
        {
            "season": F.year("game_date").cast("bigint"),
            "away_score": F.col("visiting_team_score").cast("int"),
            "home_score": F.col("home_team_score").cast("int"),
        }
    )
    identity = [F.col(c) for c in ("season", "home_team", "home_team_game_number", "visiting_team", "visiting_team_game_number")]
    return typed.select(
        "game_date",
        "season",
        concat_present(*identity).alias("historical_game_id"),
        F.col("visiting_team").alias("away_team"),
        F.col("visiting_team_game_number").cast("int").alias("away_team_game_number"),
        "home_team",
        F.col("home_team_game_number").cast("int").alias("home_team_game_number"),
        F.col("away_score").alias("away_team_score"),
        F.col("home_score").alias("home_team_score"),
        flag(F.col("home_score") > F.col("away_score")).alias("home_team_is_winner"),
        flag(F.col("home_score") == F.col("away_score")).alias("is_tie"),
        flag(F.col("day_night") == "N").alias("night_game"),
        "park_id",
        F.col("time_of_game_minutes").cast("int").alias("time_of_game_minutes"),
    )


def teams(raw: DataFrame) -> DataFrame:
    return raw.select("team", "city", "nickname")


def ballparks(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("parkid").alias("park_id"),
        F.col("name").alias("park_name"),
        F.col("city").alias("park_city"),
        F.col("state").alias("park_state"),
    )


def population(raw: DataFrame) -> DataFrame:
    """The greatest estimate per area and year."""
    return greatest_per_key(raw, ["geographic_area", "year"], "population")
