"""Tables by definition, a landed year built anew, and a hot day."""

import datetime as dt
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daygrain.plans import city_days, refresh
from daygrain.sinks import tables
from daygrain.sources import files


def test_each_kind_of_table(spark, rows, tmp_path):
    base, day = str(tmp_path), lambda n: dt.date(2024, 5, n)
    whole = refresh.Table("whole", refresh.FULL, unique=("k",))
    keyed = refresh.Table("keyed", refresh.BY_KEY, key="k")
    dated = refresh.Table("dated", refresh.TIME_RANGE, time="d", numeric=("n",))
    one = spark.createDataFrame([(1, day(1), "5"), (2, day(2), "6")], "k int, d date, n string")
    two = spark.createDataFrame([(2, day(2), "7"), (3, day(2), "8")], "k int, d date, n string")
    for df in (one, two):
        for table in (whole, keyed, dated):
            path = refresh.refresh(df, table, base, day(1) if df is one else day(2), day(3))
            assert path == f"{base}/{table.name}"
    assert rows(tables.read_table(spark, f"{base}/whole"), "k") == [(2,), (3,)]
    assert rows(tables.read_table(spark, f"{base}/keyed"), "k", "n") == [(1, "5"), (2, "7"), (3, "8")]
    assert rows(tables.read_time_range(spark, f"{base}/dated", one.schema.simpleString()[7:-1].replace(":", " ")), "k") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError, match="unique"):
        refresh.refresh(two.union(two), whole, base)
    with pytest.raises(ValueError, match="zero up"):
        refresh.refresh(two.withColumn("n", F.lit("-1")), dated, base, day(2), day(3))
    assert tables.read_table(spark, f"{base}/whole").count() == 2
    for _ in range(3):
        refresh.refresh(one, whole, base)
    assert len(tables.versions(spark, f"{base}/whole")) == 2


def test_names_in_definitions_are_told_apart():
    assert len(refresh.TABLES) == len(refresh.DEFINED)
    assert all(t.time if t.kind == refresh.TIME_RANGE else t.key if t.kind == refresh.BY_KEY else True for t in refresh.DEFINED)


def test_a_landed_year_is_built_anew(spark, rows, tmp_path):
    def land(city, date, *hours):
        found = [{"icaoId": city, "reportTime": f"{date}T{h:02d}:00:00.000Z", "temp": float(h)} for h in hours]
        (tmp_path / f"{city}_weather_report_metar_{date}.json").write_text(json.dumps(found))

    land("aa", "2025-03-01", 1, 5, 9)
    land("aa", "2025-03-02", 3)
    land("bb", "2025-03-01", 7)
    land("bb", "2024-03-01", 8)
    refresh.recompile_year(spark, str(tmp_path), str(tmp_path / "sets"), ["aa", "bb"], 2025)
    read = lambda city: rows(files.read_observations(spark, str(tmp_path / "sets"), city), F.hour("reportTime"))
    assert read("aa") == [(1,), (3,), (5,), (9,)]
    assert read("bb") == [(7,)]


def test_one_day_with_all_rows_uses_several_tasks(spark):
    n = 200_000
    df = spark.range(n).select(
        F.lit(dt.date(2024, 5, 1)).alias("entry_date"),
        F.format_string("%08d", (F.col("id") * 7919) % n).alias("game_id"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("team_game_number"),
        ((F.col("id") * 31) % 1000).alias("won"),
    )
    found = city_days.carried(df, ["won"])
    assert found.select(F.spark_partition_id()).distinct().count() > 1
    ten = Window.orderBy("entry_date", "game_id").rowsBetween(-9, 0)
    plain = df.withColumn("won_lag", F.when(F.col("team_game_number").isNull(), F.max("won").over(ten)).otherwise(F.col("won")))
    assert found.exceptAll(plain.select(found.columns)).isEmpty() and found.count() == n
