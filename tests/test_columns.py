"""Column helpers at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain.functions import columns as C
from daygrain.operators import quality
from daygrain.plans import staging


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_text(spark):
    none = F.lit(None).cast("string")
    assert value(spark, C.concat_present(F.lit("a"), none, F.lit(3))) == "a3"
    assert value(spark, C.concat_strict(F.lit("a"), ", ", none)) is None
    assert value(spark, C.grouped_digits_to_long(F.lit("1,234,567"))) == 1234567
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, C.grouped_digits_to_long(F.lit("12x")))


def test_numbers(spark):
    assert value(spark, C.round_to(F.lit(1.005), 2)) == 1.0
    assert value(spark, C.round_to(F.lit(-2.5), 0)) == -3.0
    assert value(spark, C.fahrenheit(F.lit(13.3))) == 55.94
    assert value(spark, C.per_100k(F.lit(7), F.lit(0))) is None
    assert value(spark, C.per_100k(F.lit(7), F.lit(1600000))) == 0.438
    assert value(spark, C.absent_nan(F.lit(float("nan")))) is None


def test_instants(spark):
    assert value(spark, C.iso_instant(F.lit("2025-09-09T12:00:00.250Z"))) == dt.datetime(2025, 9, 9, 12, 0, 0, 250000)
    assert value(spark, C.hours_earlier(F.lit("2025-01-01 04:03:00").cast("timestamp_ntz"), 5)) == dt.datetime(2024, 12, 31, 23, 3)


def test_intervals_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
        assert value(spark, C.in_range(at, dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 31))) is True
        assert value(spark, C.in_range(at, dt.datetime(2024, 3, 10, 2, 31), dt.datetime(2024, 3, 10, 3))) is False
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_outcome_order_and_unknown_winner(spark):
    label = lambda tie, away, home, won: value(spark, C.outcome_label(*[F.lit(v).cast(t) for v, t in zip((tie, away, home, won), ("boolean", "int", "int", "boolean"))]))
    assert label(True, 1, 1, None) == "tie"
    assert label(False, 1, 1, True) is None
    assert label(None, 1, 1, True) == "win"
    assert label(False, None, 1, None) == "loss"
    assert value(spark, C.flag(F.lit(None).cast("boolean"))) is False


def test_unknown_winner_counts_for_the_away_side(spark, rows):
    from daygrain.plans.games import current_sides

    game = spark.createDataFrame(
        [("g", "A", None, "H", None, None, None)],
        "game_id string, away_team_name string, away_team_score int, home_team_name string, home_team_score int, home_team_is_winner boolean, is_tie boolean",
    )
    blank = ["game_date", "season", "away_team_record_wins", "away_team_record_losses", "home_team_record_wins", "home_team_record_losses", "series_game_number", "night_game"]
    game = game.withColumns({c: F.lit(None).cast("int") for c in blank})
    assert rows(current_sides(game.unionByName(game)), "team", "outcome") == [("A", "win"), ("H", "loss")]


def test_quality_checks(spark, rows):
    df = spark.createDataFrame([(1, "5", "2"), (1, "-1", "2"), (2, "x", "3"), (None, "1", "1"), (None, "1", None)], "k int, a string, b string")
    assert rows(quality.duplicate_keys(df, "k")) == [(1,)]
    assert quality.not_numeric_non_negative(df, ["a", "b"]).count() == 3
    assert quality.not_numeric_non_negative(df, ["a", "b"]).columns == ["number_a", "number_b"]
    quality.require_empty(quality.duplicate_keys(df, "a").where("a = 'none'"), "unique a")
    with pytest.raises(ValueError, match="unique k"):
        quality.require_empty(quality.duplicate_keys(df, "k"), "unique k")


def test_historical_staging_is_strict(spark):
    raw = spark.createDataFrame([("3.7",)], "visiting_team_score string").withColumn("game_date", F.lit("2001-04-01").cast("date"))
    names = ["visiting_team", "home_team", "visiting_team_game_number", "home_team_game_number", "home_team_score", "day_night", "park_id", "time_of_game_minutes"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.historical_games(raw.withColumns({n: F.lit("1") for n in names})).collect()
