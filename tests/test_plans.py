"""Plan shapes that matter at scale."""

import datetime as dt

from pyspark.sql import functions as F

from daygrain.plans import games
from daygrain.sinks import tables
from daygrain.sources import files, schemas, snapshots
from proofs.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[0]


def test_observation_reads_prune_years_and_push_the_interval(spark, tmp_path):
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.OBSERVATION.fields if f.name != "reportTime"]
    times = spark.range(0, 1000, 7).select(F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2023-01-01").cast("timestamp_ntz")).alias("reportTime"), *columns)
    tables.write_yearly(times.select(*schemas.OBSERVATION.names, F.lit("x").alias("city")), str(tmp_path / "y"))
    plan = final_plan(files.read_observations(spark, str(tmp_path / "y"), "x", dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)).select("temp"))
    assert "PartitionFilters: [isnotnull(city" in plan and "year" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(reportTime" in plan and "ReadSchema: struct<reportTime:timestamp_ntz,temp:double>" in plan


def test_listing_files_reads_no_contents(spark, tmp_path):
    (tmp_path / "a_2024-01-01.csv").write_text("x")
    plan = final_plan(snapshots.list_paths(spark, str(tmp_path)))
    assert "ReadSchema: struct<path:string>" in plan


def test_daily_rates_shuffle_days_only(spark):
    rates = REGISTRY["gold_crime"][0](spark, FOLDER)
    rates.collect()
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Exchange hashpartitioning(dispatch_date" in plan and "Exchange hashpartitioning(o_custkey" not in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_records_use_one_row_exchange_after_storing(spark):
    team_games = spark.range(500).select(
        F.lit(2000).alias("season"), F.lit("a").alias("team"), (F.col("id") + 1).alias("game_number"),
        F.when(F.col("id") % 3 == 0, F.lit("loss")).otherwise(F.lit("win")).alias("outcome"), F.col("id").cast("string").alias("game_id"),
        F.lit(1).alias("score"), F.lit("2000-01-01").cast("date").alias("game_date"), F.lit(True).alias("home_team"), F.lit(True).alias("night_game"),
        F.lit(1).alias("time_of_game_minutes"), F.lit(None).cast("int").alias("current_record_wins"), F.lit(None).cast("int").alias("current_record_losses"),
    )
    records = games.with_records(games.with_running_counts(team_games))
    plan = final_plan(records)
    # Windows ran before storing; reading the records back neither shuffles nor joins rows.
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "Join" not in plan


def test_last_row_per_day_aggregates_before_the_shuffle(spark):
    plan = final_plan(REGISTRY["w10_last_row_per_day"][0](spark, FOLDER))
    assert "partial_max_by" in plan and "Window" not in plan


def test_no_query_compares_all_pairs(spark):
    for name in ("j7_three_way_days", "p6_pick_by_side_j3_either_team", "s18_tail_replace", "w8_day_norms", "s12_greatest_stamp", "a15_bootstrap_band"):
        plan = final_plan(REGISTRY[name][0](spark, FOLDER))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
