"""Input that does not parse raises; statistics of awkward input."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from daygrain.operators import consolidate, joins, stats
from daygrain.plans import raw
from daygrain.sinks import tables
from daygrain.sources import files, schemas
from daygrain.streaming import landing

OBSERVED = {"icaoId": "KPHL", "reportTime": "2025-03-01T02:00:00.000Z", "temp": 1.5}


def text(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.mark.parametrize("line", ["4,5", "6,7,8,9"])
def test_ragged_csv_raises(spark, tmp_path, line):
    header = text(tmp_path / "names.csv", "a,b,c")
    whole = text(tmp_path / "whole.csv", "a,b,c", "1,2,3", line)
    bare = text(tmp_path / "bare.csv", "1,2,3", line)
    titled = text(tmp_path / "titled.csv", "a title", "a,b,c", "1,2,3", line)
    readers = [
        lambda: files.read_csv_text(spark, whole, ["a", "b", "c"]),
        lambda: files.read_csv_named_apart(spark, bare, header),
        lambda: files.read_csv_after_preamble(spark, titled, 1),
    ]
    for read in readers:
        with pytest.raises(Exception, match="MALFORMED|fields"):
            read().collect()
        with pytest.raises(Exception, match="MALFORMED|fields"):
            read().select("a").collect()


def test_notes_below_the_data_stay(spark, rows, tmp_path):
    titled = text(tmp_path / "t.csv", "a title", "a,b,c", "1,2,3", "Note: no more")
    assert rows(files.read_csv_after_preamble(spark, titled, 1)) == [("1", "2", "3"), ("Note: no more", None, None)]


def test_broken_json_raises(spark, tmp_path):
    good = json.dumps({"rows": [{"dc_key": 1, "hour": 12}]})
    text(tmp_path / "a/good.json", good)
    text(tmp_path / "a/cut.json", good[:-8])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        files.read_envelope(spark, str(tmp_path / "a"), schemas.INCIDENT).collect()


@pytest.mark.parametrize("change", [{"reportTime": "2025-03-01 02:00"}, {"temp": "warm"}])
def test_odd_observation_raises_also_in_the_stream(spark, tmp_path, change):
    text(tmp_path / "in/metar_2025-03-01.json", json.dumps([OBSERVED, OBSERVED | change]))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        files.read_observation_arrays(spark, str(tmp_path / "in")).collect()
    stream = landing.landing_stream(spark, str(tmp_path / "in"))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        landing.run_available(stream, str(tmp_path / "table"), str(tmp_path / "check"))


def test_rows_without_a_time_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 5, 1), 1), (None, 2)], "d date, v int")
    with pytest.raises(Exception, match="has no d"):
        tables.write_time_range(df, str(tmp_path / "t"), "d", dt.date(2024, 5, 1), dt.date(2024, 5, 3))


def test_zip_members_encoding_and_width(spark, rows, tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("data.csv", "é,1\nb,2\n".encode("latin-1"))
        archive.writestr("README", "not, data, at all")
    assert rows(files.read_zipped_csv(spark, str(path), ["a", "b"], encoding="latin-1"), "a", "b") == [("b", "2"), ("é", "1")]
    with pytest.raises(Exception, match="fields"):
        files.read_zipped_csv(spark, str(path), ["a", "b", "c"], encoding="latin-1").collect()


def test_station_snapshot_of_several_files(spark, tmp_path):
    header = "Date,TAVG (Degrees Fahrenheit),TMAX (Degrees Fahrenheit),TMIN (Degrees Fahrenheit),PRCP (Inches),SNOW (Inches),SNWD (Inches)"
    for part, day in (("one", "2024-04-01"), ("two", "2024-04-02")):
        text(tmp_path / f"weather/philadelphia/ncei/2024-04-04/{part}.csv", f'"{part}, PA"', header, f"{day},50,60,40,0.00,,")
    found = raw.station_days(spark, str(tmp_path), "philadelphia", dt.date(2024, 4, 1), dt.date(2024, 5, 1), dt.date(2024, 4, 5))
    assert found.count() == 2


NAN = float("nan")


def test_nan_is_absent(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (2.0, 4.0, 2), (3.0, NAN, 3), (NAN, 1.0, 4), (4.0, 8.0, 5)], "x double, y double, k int")
    assert [r["r"] for r in stats.correlation_matrix(df, ["x", "y"]).collect()] == [1.0]
    assert tuple(stats.correlation_band(df, "x", "y").first()) == (1.0, "strong")
    fit = stats.linear_fit(df, "x", "y").first()
    assert (round(fit["slope"], 9), fit["n"]) == (2.0, 3)
    assert stats.means_at(df, "x", "y").count() == 3
    assert stats.conditional_means(df, {"y": "y"}, {}).first()["mean"] == 3.75
    band = stats.bootstrap_band(df, "x", "y", ["k"], replicates=5, points=2).orderBy("x").collect()
    assert [round(r["fit"], 9) for r in band] == [2.0, 8.0]
    nothing = spark.createDataFrame([(NAN, 1.0)], "x double, y double")
    assert tuple(stats.correlation_band(nothing, "x", "y").first()) == (None, None)


def test_bootstrap_far_from_zero(spark):
    df = spark.range(1000).select((F.col("id") + 1.7e9).alias("x"), (F.col("id") * 3.0 + 5).alias("y"), "id")
    for row in stats.bootstrap_band(df, "x", "y", ["id"], replicates=20, points=3).collect():
        exact = 3 * (row["x"] - 1.7e9) + 5
        assert all(abs(row[c] - exact) < 1e-6 for c in ("fit", "low", "high"))


@pytest.mark.parametrize("found, classes", [([], 0), ([(1.0, 1), (2.0, 1)], 1), ([(1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1)], 2), ([(1.0, 0), (1.0, 1)], 2)])
def test_logistic_fit_without_a_finite_answer(spark, found, classes):
    fit = stats.logistic_fit(spark.createDataFrame(found, "x double, y int"), "x", "y").first()
    assert tuple(fit) == (None, None, classes, False)


def test_poisson_reaches_the_end_of_its_distribution():
    limits = stats.poisson_limits()
    assert limits == sorted(set(limits)) and 11 <= len(limits) <= 13 and limits[-1] < stats.PRIME


@pytest.mark.parametrize("stored", [True, False])
def test_a_write_killed_between_delete_and_rename_loses_nothing(spark, rows, tmp_path, monkeypatch, stored):
    table, day = str(tmp_path / "t"), lambda n, h=0: dt.datetime(2024, 5, n, h)
    schema, file_date = "t timestamp_ntz, v string, file_date date", dt.date(2024, 5, 1)
    old = spark.createDataFrame([(day(1, 3), "kept", file_date), (day(1, 9), "old", file_date), (day(2), "old", file_date)], schema)
    tables.write_time_range(old, table, "t", dt.date(2024, 5, 1), dt.date(2024, 5, 3))
    batch = spark.createDataFrame([(day(1, 8), "new", file_date)], schema)
    whole = tables._swap_in

    def dies(spark, table, staged):
        fs, folder = tables._folder(spark, f"{table}/day=2024-05-01")
        fs.delete(folder, True)
        if not stored:
            fs, marker = tables._folder(spark, f"{staged}/_SUCCESS")
            fs.delete(marker, False)
        raise RuntimeError("killed")

    if not stored:  # dies before all rows are stored, so before anything is deleted
        monkeypatch.setattr(tables, "_swap_in", lambda spark, table, staged: dies(spark, f"{table}/nowhere", staged))
    else:
        monkeypatch.setattr(tables, "_swap_in", dies)
    with pytest.raises(RuntimeError):
        landing.absorb(batch, table, "t")
    monkeypatch.setattr(tables, "_swap_in", whole)
    if not stored:
        tables.finish_pending(spark, table)
        assert rows(tables.read_time_range(spark, table, schema))[1][1] == "old"
    landing.absorb(batch, table, "t")
    assert rows(tables.read_time_range(spark, table, schema), "t", "v") == [(day(1, 3), "kept"), (day(1, 8), "new")]
    landing.absorb(batch, table, "t")
    assert tables.read_time_range(spark, table, schema).count() == 2


def counting(spark, df, column):
    """The rows, and a counter of how often any of them was made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def seen(_):
        made.add(1)
        return True

    return df.where(seen(column)), made


def test_inputs_are_evaluated_once(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 5, 1 + k % 3, k % 24), "v", dt.date(2024, 5, 1 + k % 4), "c") for k in range(60)], "t timestamp_ntz, v string, file_date date, city string")
    new, made = counting(spark, rows, "v")
    assert consolidate.consolidate(rows.where("t < timestamp_ntz'2024-05-01 05:00'"), new, "t").count() >= 60 and made.value == 60
    files_, made = counting(spark, rows, "v")
    assert consolidate.recompile(files_, "file_date", "t", ["city"]).count() > 0 and made.value == 60
    many, made = counting(spark, spark.range(50).selectExpr("id % 7 AS a", "id"), "id")
    one, made_one = counting(spark, spark.range(9).selectExpr("id AS b"), "b")
    assert joins.full_outer_split(many, one, "a", "b").count() == 52 and (made.value, made_one.value) == (50, 9)


def test_an_upsert_of_one_key_rewrites_one_bucket(spark, rows, tmp_path):
    table = str(tmp_path / "t")
    tables.upsert(spark.range(500).selectExpr("id AS k", "'old' AS v"), table, "k")
    before = tables._buckets(spark, tables.versions(spark, table)[-1])
    tables.upsert(spark.createDataFrame([(7, "new")], "k bigint, v string"), table, "k")
    after = tables._buckets(spark, tables.versions(spark, table)[-1])
    assert len(before) == len(after) == tables.BUCKETS and sum(before[n] != after[n] for n in before) == 1
    assert rows(tables.read_table(spark, table)) == sorted([(k, "new" if k == 7 else "old") for k in range(500)], key=repr)
    tables.drop_old_versions(spark, table, keep=1)
    assert tables.read_table(spark, table).count() == 500 and len(tables.versions(spark, table)) == 1
    tables.write_full(spark.range(3).selectExpr("id AS k", "'whole' AS v"), table)
    tables.upsert(spark.createDataFrame([(2, "new"), (9, "new")], "k bigint, v string"), table, "k")
    assert rows(tables.read_table(spark, table)) == [(0, "whole"), (1, "whole"), (2, "new"), (9, "new")]


def test_a_swap_killed_between_two_days_is_completed(spark, rows, tmp_path, monkeypatch):
    table, schema = str(tmp_path / "t"), "d date, v string"
    day = lambda n: dt.date(2024, 5, n)
    tables.write_time_range(spark.createDataFrame([(day(n), "old") for n in range(1, 6)], schema), table, "d", day(1), day(6))
    real, done = tables._rename, []

    def dies(fs, old, new):
        if len(done) == 2:
            raise RuntimeError("killed")
        done.append(new)
        real(fs, old, new)

    monkeypatch.setattr(tables, "_rename", dies)
    with pytest.raises(RuntimeError):
        tables.write_time_range(spark.createDataFrame([(day(n), "new") for n in (1, 3, 4)], schema), table, "d", day(1), day(5))
    monkeypatch.setattr(tables, "_rename", real)
    tables.finish_pending(spark, table)
    tables.finish_pending(spark, table)
    assert rows(tables.read_time_range(spark, table, schema)) == [(day(1), "new"), (day(3), "new"), (day(4), "new"), (day(5), "old")]


def test_building_the_game_table_takes_fewer_jobs(spark):
    """Landing copies included; it were 46 when counts, look back and streaks were stored one after the other."""
    from proofs.queries import REGISTRY

    spark.sparkContext.setJobGroup("games", "building")
    table = REGISTRY["gold_games"][0](spark, "/root/testdata/sf0.001")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("games"))
    spark.sparkContext.setJobGroup("other", "other")
    assert table.count() > 0 and jobs <= 40
