"""Recompiling in one pass equals folding file by file; the stream does the same."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from daygrain.operators.consolidate import consolidate, recompile
from daygrain.sinks import tables
from daygrain.sources import schemas
from daygrain.streaming.landing import landing_stream, run_available


def fold(files):
    """Files [(date, [times])] consolidated one after another."""
    kept = []
    for _, times in sorted(files):
        known = [t for t in times if t is not None]
        first = min(known) if known else None
        kept = [t for t in kept if first is not None and t is not None and t < first] + times
    return sorted(kept, key=repr)


def test_recompile_equals_the_fold(spark):
    source, expected, found = random.Random(11), {}, []
    for city in range(150):
        files = [(d, [source.choice([None] + list(range(20)) * 3) for _ in range(source.randint(1, 4))]) for d in source.sample(range(9), source.randint(1, 6))]
        expected[city] = fold(files)
        found += [(city, d, t) for d, times in files for t in times]
    df = spark.createDataFrame(found, "city int, file_date int, t int")
    got = {}
    for r in recompile(df, "file_date", "t", ["city"]).collect():
        got.setdefault(r.city, []).append(r.t)
    assert {c: sorted(ts, key=repr) for c, ts in got.items()} == {c: ts for c, ts in expected.items() if ts}


def test_consolidate_keeps_cities_apart(spark, rows):
    old = spark.createDataFrame([("a", 1), ("a", 5), ("b", 9), ("c", 3)], "city string, t int")
    new = spark.createDataFrame([("a", 4), ("b", 2)], "city string, t int")
    assert rows(consolidate(old, new, "t", ["city"])) == [("a", 1), ("a", 4), ("b", 2), ("c", 3)]


def land(folder, day, times):
    stamp = lambda t: t.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    text = json.dumps([{"icaoId": "KX", "reportTime": stamp(t), "clouds": ["x"], "surprise": 1} for t in times], indent=1)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"x_weather_report_metar_{day}.json").write_text(text)


def test_stream_takes_each_file_once_and_keeps_the_fold(spark, tmp_path):
    landing, table, progress = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "progress")
    at = lambda d, h: dt.datetime(2025, 3, d, h)
    read = lambda: sorted(r.reportTime for r in tables.read_time_range(spark, table, "icaoId string, reportTime timestamp_ntz").collect())

    def run():
        run_available(landing_stream(spark, str(landing)).select("icaoId", "reportTime", "file_date"), table, progress)

    land(landing / "2025", "2025-03-01", [at(1, 1), at(1, 20)])
    land(landing / "2025", "2025-03-02", [at(2, 1), at(2, 2)])
    run()
    assert read() == [at(1, 1), at(1, 20), at(2, 1), at(2, 2)]
    # The next file reaches back into the first day: everything from there on is replaced.
    land(landing / "2025", "2025-03-03", [at(1, 19), at(3, 4)])
    run()
    assert read() == [at(1, 1), at(1, 19), at(3, 4)]
    run()
    assert read() == [at(1, 1), at(1, 19), at(3, 4)]


def test_observation_arrays_and_yearly_sets(spark, tmp_path):
    from daygrain.sources import files

    land(tmp_path / "day", "2025-03-01", [dt.datetime(2024, 12, 31, 23), dt.datetime(2025, 3, 1, 4)])
    parsed = files.read_observation_arrays(spark, str(tmp_path / "day"))
    assert parsed.columns == schemas.OBSERVATION.names and len(parsed.columns) == 31
    base = str(tmp_path / "yearly")
    tables.write_yearly(parsed.withColumn("city", F.lit("x")), base)
    tables.write_yearly(parsed.where(F.year("reportTime") == 2025).withColumn("city", F.lit("x")), base)
    found = files.read_observations(spark, base, "x", dt.datetime(2024, 12, 1), dt.datetime(2025, 3, 1, 4))
    assert [r.reportTime for r in found.collect()] == [dt.datetime(2024, 12, 31, 23)]
    assert files.read_observations(spark, base, "x").count() == 2


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    from daygrain.streaming.landing import absorb

    table = str(tmp_path / "table")
    at = lambda d, h: dt.datetime(2025, 3, d, h)
    schema = "reportTime timestamp_ntz, file_date date"
    first = spark.createDataFrame([(at(1, 1), dt.date(2025, 3, 1)), (at(2, 5), dt.date(2025, 3, 2))], schema)
    second = spark.createDataFrame([(at(2, 4), dt.date(2025, 3, 3)), (at(2, 9), dt.date(2025, 3, 3))], schema)
    for batch in (first, first, second, second, second.where("false")):
        absorb(batch, table)
    found = sorted(r.reportTime for r in tables.read_time_range(spark, table, schema).collect())
    assert found == [at(1, 1), at(2, 4), at(2, 9)]
