"""Rewritten joins against the joins they replace."""

import random

from pyspark.sql import functions as F

from daygrain.operators import joins
from daygrain.plans import city_days


def compares_all_pairs(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "NestedLoop" in plan or "Cartesian" in plan


def test_either_side_equals_the_or_join(spark, rows):
    source = random.Random(5)
    keys = ["a", "b", "c", None]
    games = spark.createDataFrame([(i, source.choice(keys), source.choice(keys)) for i in range(60)], "id int, home string, away string")
    teams = spark.createDataFrame([("a",), ("b",), ("z",)], "code string")
    written = games.join(teams, (F.col("code") == F.col("home")) | (F.col("code") == F.col("away")))
    ours = joins.explode_either(games, F.col("home"), F.col("away"), "side", "at_home").join(teams, F.col("code") == F.col("side"))
    assert rows(ours, "id", "code") == rows(written, "id", "code")
    assert compares_all_pairs(written) and not compares_all_pairs(ours)


def test_three_way_days_equal_the_or_join(spark, rows):
    source = random.Random(6)

    def days(name, value, size, distinct):
        picks = source.sample(range(20), size) if distinct else [source.randrange(24) for _ in range(size)]
        df = spark.createDataFrame([(p, i) for i, p in enumerate(picks)] + [(None, -1)], f"d int, {value} int")
        return df.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias(name), value)

    a, b, c = days("dispatch_date", "x", 12, True), days("report_date", "y", 12, True), days("game_date", "z", 40, False)
    written = a.join(b, F.col("dispatch_date") == F.col("report_date"), "full").join(
        c, (F.col("dispatch_date") == F.col("game_date")) | (F.col("report_date") == F.col("game_date")), "full"
    )
    ours = city_days.joined_days(a, b, c)
    columns = ["dispatch_date", "x", "report_date", "y", "game_date", "z"]
    assert rows(ours, *columns) == rows(written, *columns)
    assert not compares_all_pairs(ours)


def test_default_row_present_and_absent(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    many = spark.createDataFrame([(2020, 5), (2021, 6), (None, 9)], "year int, pop int")
    order = [F.col("year").desc_nulls_last()]
    assert rows(joins.with_default_row(df, many, order)) == [(1, 2021, 6), (2, 2021, 6)]
    assert rows(joins.with_default_row(df, many.where("false"), order)) == [(1, None, None), (2, None, None)]


def test_full_outer_split_on_a_hot_key(spark, rows):
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(3, 7), (None, 8)], "mk int, v int")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "ok int, w string")
    written = many.join(one, F.col("mk") == F.col("ok"), "full")
    assert rows(joins.full_outer_split(many, one, "mk", "ok")) == rows(written)
