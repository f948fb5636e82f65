"""Golden cases: one consolidation and five days of reconciled weather."""

import datetime as dt

from pyspark.sql import functions as F

from daygrain.functions.columns import iso_instant
from daygrain.operators.consolidate import consolidate
from daygrain.plans.weather import daily_weather
from daygrain.sources import schemas


def observed(spark, texts):
    one = spark.createDataFrame([(t,) for t in texts], "t string").select(iso_instant(F.col("t")).alias("reportTime"))
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.OBSERVATION.fields if f.name != "reportTime"]
    return one.select("reportTime", *others).select(*schemas.OBSERVATION.names)


def test_new_observation_replaces_the_tail(spark):
    new = observed(spark, ["2025-09-09T12:00:00.000Z"])
    existing = observed(spark, ["2025-09-09T13:00:00.000Z", "2025-09-08T14:00:00.000Z"])
    result = consolidate(existing, new)
    assert len(result.columns) == 31 and "clouds" not in result.columns
    kept = sorted(r.reportTime for r in result.collect())
    assert kept == [dt.datetime(2025, 9, 8, 14), dt.datetime(2025, 9, 9, 12)]


def test_first_batch_is_kept_whole_and_empty_batch_changes_nothing(spark):
    new = observed(spark, ["2025-09-09T12:00:00.000Z"])
    assert consolidate(None, new).count() == 1
    assert consolidate(new, new.where("false")).count() == 1


STATION = [
    ("2025-01-01", None, "65", "43", "0.1"),
    ("2025-01-02", "48", "50", "32", "0.0"),
    ("2025-01-03", None, "48", "28", "0.7"),
]
WINTER = [("2024-12-31 11:53", 55.94, None), ("2025-01-01 01:00", 55.76, 0.005), ("2025-01-01 02:00", 55.4, None)]
SUMMER = [61.16, 60.80, 60.2, 61.7, 62.96, 64.58, 66.2, 69.98, 71.06, 71.60, 71.96, 72.50, 72.50, 71.96, 72.50, 71.96]
PART, OFFICIAL = "METAR - INCOMPLETE", "NCEI"
EXPECTED = [
    (dt.date(2024, 12, 31), 55.94, PART, 55.94, PART, 55.94, PART, 0.0, PART),
    (dt.date(2025, 1, 1), 55.58, PART, 65.0, OFFICIAL, 43.0, OFFICIAL, 0.1, OFFICIAL),
    (dt.date(2025, 1, 2), 48.0, OFFICIAL, 50.0, OFFICIAL, 32.0, OFFICIAL, 0.0, OFFICIAL),
    (dt.date(2025, 1, 3), None, "NA", 48.0, OFFICIAL, 28.0, OFFICIAL, 0.7, OFFICIAL),
    (dt.date(2025, 7, 14), 67.73, "METAR", 72.5, "METAR", 60.2, "METAR", 0.05, "METAR"),
]


def test_daily_weather_with_every_label(spark, rows):
    summer = [(f"2025-07-14 {h:02d}:00", t, {7: 0.04, 13: 0.01}.get(h)) for h, t in enumerate(SUMMER)]
    text = spark.createDataFrame(WINTER + summer, "at string, temp_deg_f double, precip_last_6hrs_inches double")
    observations = text.withColumn("report_time_est", F.col("at").cast("timestamp_ntz")).drop("at")
    station = spark.createDataFrame(
        STATION, "report_date string, avg_temp_deg_f string, max_temp_deg_f string, min_temp_deg_f string, total_precip_inches string"
    )
    figures = ("avg_temp_deg_f", "max_temp_deg_f", "min_temp_deg_f", "total_precip_inches")
    columns = [c for f in figures for c in (f, f"{f}_source")]
    assert rows(daily_weather(observations, station), "report_date", *columns) == sorted(EXPECTED, key=repr)
