"""Chunked windows against plain windows and a plain loop."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daygrain.operators import ordered
from daygrain.plans import games


def random_games(seed, size=400, repeats=True):
    """Team games with gaps, repeated numbers, ties, unknown outcomes, numbers and teams."""
    source, found = random.Random(seed), []
    for i in range(size):
        team = source.choice(["a", "a", "a", "b", None])
        number = source.choice([None] + list(range(1, 120)) * 3) if repeats else i + 1
        outcome = source.choice(["win"] * 6 + ["loss"] * 3 + ["tie", None])
        found.append((2000 + source.randrange(2), team, number, outcome, f"g{i:04d}", source.randrange(10)))
    return found


SCHEMA = "season bigint, team string, game_number bigint, outcome string, game_id string, score int"


def frame(spark, found):
    df = spark.createDataFrame(found, SCHEMA)
    return df.withColumns(
        {
            # Days follow the ids, as they decide the order of rows without a number; some are unknown.
            "game_date": F.when(F.col("game_id") < "g0350", F.date_add(F.lit("2000-01-01").cast("date"), F.substring("game_id", 2, 3).cast("int"))),
            "home_team": F.lit(True),
            "night_game": F.lit(True),
            "time_of_game_minutes": F.lit(1),
            "current_record_wins": F.when(F.col("score") == 0, F.lit(99)),
            "current_record_losses": F.when(F.col("score") == 1, F.lit(98)),
        }
    )


def loop_records(found):
    """Streaks and records by walking each season; NULL numbers come last."""
    groups, result = {}, {}
    for row in found:
        groups.setdefault((row[0], row[1]), []).append(row)
    for (_, team), members in groups.items():
        members.sort(key=lambda r: (r[2] is None, r[2] or 0, r[4]))
        seen, islands, wins, losses, shares = {}, {}, 0, 0, []
        for _, _, number, outcome, game, score in members:
            seen[outcome] = seen.get(outcome, 0) + 1
            island = None if outcome is None or number is None else (outcome, number - seen[outcome])
            islands[island] = islands.get(island, 0) + (number is not None)
            wins += outcome == "win" and team is not None
            losses += outcome == "loss" and team is not None
            shares.append(int(outcome == "win"))
            share = lambda last: math.floor(sum(shares[-last:]) / len(shares[-last:]) * 1000 + 0.5) / 1000
            result[game] = (
                islands[island] * (1 if outcome == "win" else -1),
                99 if score == 0 else wins,
                98 if score == 1 else losses,
                share(len(shares)),
                share(10),
                share(40),
            )
    return result


@pytest.mark.parametrize("seed,repeats,chunk", [(1, True, 64), (2, True, 50), (3, False, 64), (4, True, 4096)])
def test_records_equal_a_plain_loop(spark, seed, repeats, chunk):
    found = random_games(seed, repeats=repeats)
    counted = games.with_running_counts(frame(spark, found), rows=7 if chunk < 100 else chunk)
    records = games.with_records(counted).collect()
    expected = loop_records(found)
    assert len(records) == len(found)
    for r in records:
        figures = (r.current_streak, r.current_record_wins, r.current_record_losses, r.current_win_pct, r.last_10_win_pct, r.last_40_win_pct)
        assert figures == expected[r.game_id], r


def test_streak_of_one_outcome_over_many_blocks(spark):
    found = [(2000, "a", i + 1, "win", f"g{i:04d}", 5) for i in range(300)]
    records = games.with_records(games.with_running_counts(frame(spark, found), rows=16))
    assert {r.game_number: r.current_streak for r in records.collect()} == {i + 1: i + 1 for i in range(300)}


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_counts_and_looking_back_equal_plain_windows(spark, rows, keys):
    df = spark.range(1000).select(F.col("id").alias("at"), (F.col("id") % 3).alias("k"), (F.xxhash64("id") % 50).alias("v"))
    df = df.withColumn("k", F.when(F.col("k") < 2, F.col("k"))).withColumn("part", F.floor(F.col("at") / 90))
    plain = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("at")
    numbered = ordered.running_counts(df, keys, "part", [F.col("at")], {"n": F.lit(True), "big": F.col("v") > 20})
    looked = ordered.looking_back(numbered, keys, "n", 9, {"m": lambda w: F.max("v").over(w.rowsBetween(-9, 0))}, rows=16)
    expected = df.select(
        "at",
        F.row_number().over(plain).cast("bigint"),
        F.count_if(F.col("v") > 20).over(plain.rowsBetween(Window.unboundedPreceding, 0)),
        F.max("v").over(plain.rowsBetween(-9, 0)),
    )
    assert rows(looked, "at", "n", "big", "m") == rows(expected)


def test_looking_back_needs_a_block_longer_than_its_reach(spark):
    with pytest.raises(ValueError):
        ordered.looking_back(spark.range(1).withColumn("n", F.lit(1)), [], "n", 10, {}, rows=10)


def test_last_and_greatest_per_key(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (1, 1, "c"), (None, 5, "d")], "k int, o int, v string")
    assert rows(ordered.last_per_key(df, ["k"], ["o"])) == [(1, 2, "b"), (None, 5, "d")]
    assert rows(ordered.greatest_per_key(df, ["k"], "o")) == [(1, 2), (None, 5)]


def test_group_mean_beside_keeps_unknown_keys(spark, rows):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 7.0)], "k int, v double")
    found = ordered.group_mean_beside(df, {"k": F.col("k")}, {"mean": F.avg("v")})
    assert rows(found) == [(1, 2.0, 3.0), (1, 4.0, 3.0), (None, 7.0, 7.0)]
