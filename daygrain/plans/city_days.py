"""One city's days: incidents, weather and one team's games side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.columns import by_side, outcome_value, round_to
from daygrain.operators.joins import full_outer_split
from daygrain.operators.ordered import CHUNK_ROWS, group_mean_beside, last_per_key, looking_back, sequence_number
from daygrain.session import cut

PERSPECTIVE = (
    "score",
    "outcome",
    "current_streak",
    "game_number",
    "current_record_wins",
    "current_record_losses",
    "current_win_pct",
    "last_10_win_pct",
    "last_40_win_pct",
)

# Display names of the city table.
DISPLAY_NAMES = {
    "max_temp_deg_f": "Daily Max Temp (F)",
    "daily_max_temp_deviation_from_max": "Daily Max Temp Deviation\nFrom Avg Daily Max (F)",
    "daily_min_temp_deviation_from_min": "Daily Min Temp Deviation\nFrom Avg Daily Min (F)",
    "min_temp_deg_f": "Daily Min Temp (F)",
    "total_precip_inches": "Precipitation (in)",
    "total_incidents_per_100k": "Incidents per 100k",
    "violent_crime_per_100k": "Violent Crime per 100k",
    "assault_per_100k": "Assaults per 100k",
    "homicide_per_100k": "Homicides per 100k",
    "theft_per_100k": "Thefts per 100k",
    "team_current_streak": "Current Win/Loss Streak\n(Loss < 0)",
    "team_outcome": "Win/Loss (Text)",
    "team_outcome_as_value": "Win/Loss",
    "team_score": "Runs Scored",
    "team_current_record_wins": "Current Record Wins",
    "team_current_record_losses": "Current Record Losses",
    "team_current_win_pct": "Current Win %",
    "team_last_10_win_pct": "Current Win %\n(Last 10 Games)",
    "team_last_40_win_pct": "Current Win %\n(Last 40 Games)",
}


def with_day_norms(weather: DataFrame) -> DataFrame:
    """Mean high and low of the calendar day over all years; 366 of them at most."""
    return group_mean_beside(
        weather,
        {"month": F.month("report_date"), "day": F.dayofmonth("report_date")},
        {
            "avg_max_temp_deg_f": round_to(F.avg("max_temp_deg_f"), 2),
            "avg_min_temp_deg_f": round_to(F.avg("min_temp_deg_f"), 2),
        },
        few=True,
    )


def games_of(games: DataFrame, team: str) -> DataFrame:
    """All games from the table where either side is the team."""
    return games.where((F.col("home_team") == team) | (F.col("away_team") == team))


def team_view(games: DataFrame, team: str) -> DataFrame:
    """A team's games with its own figures, whichever side it played on."""
    at_home = F.col("home_team") == team
    home_game = F.when(at_home, F.lit(True)).when(F.col("away_team") == team, F.lit(False))
    own = [by_side(at_home, F.col(f"home_team_{c}"), F.col(f"away_team_{c}")).alias(f"team_{c}") for c in PERSPECTIVE]
    return games_of(games, team).select(
        "game_date",
        "game_id",
        "season",
        by_side(at_home, F.col("home_team"), F.col("away_team")).alias("team"),
        home_game.alias("home_game"),
        *own,
        "night_game",
        "time_of_game_minutes",
    )


def joined_days(incidents: DataFrame, weather: DataFrame, team_games: DataFrame) -> DataFrame:
    """Three-way full outer join on the day.

    After the first join a row's two days are equal or one is missing, so matching
    either of them is matching the one that is present.
    """
    days = incidents.join(weather, F.col("dispatch_date") == F.col("report_date"), "full")
    days = days.withColumn("__day", F.coalesce("dispatch_date", "report_date"))
    joined = full_outer_split(team_games, days, "game_date", "__day")
    entry = F.coalesce("dispatch_date", "report_date", "game_date").alias("entry_date")
    return joined.select(entry, *incidents.columns, *weather.columns, *team_games.columns)


def deviation(value: str, norm: str) -> Column:
    return F.col(value) - F.col(norm)


def carried(df: DataFrame, columns: Sequence[str], rows: int = 10, block_rows: int = CHUNK_ROWS, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``<column>_lag``: on days without a game the maximum of the last rows, else the own value.

    ``keys`` name what tells cities apart in a table of several: rows of one are never carried into another.
    """
    order = [F.col("entry_date").asc_nulls_last(), F.col("game_id").asc_nulls_last()]
    # Even ranges of the order, so that one city or day may hold any share of the rows. Stored first: ranges are sampled.
    ranged = cut(df).repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id())
    placed = sequence_number(ranged, keys, "__range", order, "__position")
    recent = {f"__last_{c}": (lambda w, c=c: F.max(c).over(w.rowsBetween(-(rows - 1), 0))) for c in columns}
    looked = looking_back(placed, keys, "__position", rows - 1, recent, "__block", block_rows)
    lag = {f"{c}_lag": F.when(F.col("team_game_number").isNull(), F.col(f"__last_{c}")).otherwise(F.col(c)) for c in columns}
    return looked.withColumns(lag).select(*df.columns, *lag)


def city_days(incidents: DataFrame, weather: DataFrame, games: DataFrame, team: str) -> DataFrame:
    """The analysis table of a city and its team, unordered; sort the final result only."""
    days = joined_days(incidents, with_day_norms(weather), team_view(games, team))
    days = days.withColumns(
        {
            "daily_max_temp_deviation_from_max": deviation("max_temp_deg_f", "avg_max_temp_deg_f"),
            "daily_min_temp_deviation_from_min": deviation("min_temp_deg_f", "avg_min_temp_deg_f"),
            "team_outcome_as_value": outcome_value(F.col("team_outcome")),
        }
    )
    return carried(days, ["team_current_record_wins", "team_current_record_losses"])


def display(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(DISPLAY_NAMES)


def between_days(df: DataFrame, first: object, last: object, column: str = "entry_date") -> DataFrame:
    """Days from first to last, both included."""
    return df.where(F.col(column).between(F.lit(first), F.lit(last)))


def one_row_per_day(df: DataFrame) -> DataFrame:
    """The last game of each day; days without games keep their single row."""
    return last_per_key(df, ["entry_date"], ["entry_date", "game_id"])


def in_season(df: DataFrame) -> DataFrame:
    """Days with a known record. Double-headers stay and count twice."""
    return df.where(F.col("team_current_record_wins_lag").isNotNull())


def home_games(df: DataFrame) -> DataFrame:
    return df.where(F.col("home_game"))
