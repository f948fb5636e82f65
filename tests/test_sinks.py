"""Writers: versions, merged keys, replaced intervals."""

import datetime as dt
import os

from pyspark.sql import functions as F

from daygrain.sinks import tables


def test_full_refresh_keeps_the_last_finished_version(spark, rows, tmp_path):
    table = str(tmp_path / "t")
    assert tables.read_table(spark, table) is None
    tables.write_full(spark.range(3), table)
    tables.write_full(tables.read_table(spark, table).where("id > 0"), table)
    # A job that died left no marker, so readers never see it.
    os.makedirs(f"{table}/v00000003")
    assert rows(tables.read_table(spark, table)) == [(1,), (2,)]
    tables.write_full(spark.range(9, 10), table)
    assert rows(tables.read_table(spark, table)) == [(9,)]
    tables.drop_old_versions(spark, table, keep=1)
    assert len(tables.versions(spark, table)) == 1 and rows(tables.read_table(spark, table)) == [(9,)]


def test_upsert_new_rows_win_and_null_keys_never_match(spark, rows, tmp_path):
    table = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string"), table, "k")
    tables.upsert(spark.createDataFrame([(2, "new"), (2, "newer"), (3, "new"), (None, "new")], "k int, v string"), table, "k")
    assert rows(tables.read_table(spark, table)) == sorted([(1, "old"), (2, "newer"), (3, "new"), (None, "old"), (None, "new")], key=repr)


def test_time_range_replaces_only_its_interval(spark, rows, tmp_path):
    table, day = str(tmp_path / "t"), lambda n: dt.date(2024, 5, n)
    first = spark.createDataFrame([(day(1), "a"), (day(2), "a"), (day(3), "a"), (day(4), "a")], "d date, v string")
    tables.write_time_range(first, table, "d", day(1), day(5))
    untouched = os.listdir(f"{table}/day=2024-05-04")
    # Day 2 is replaced, day 3 became empty, the row of day 4 lies outside the interval.
    second = spark.createDataFrame([(day(2), "b"), (day(4), "b")], "d date, v string")
    tables.write_time_range(second, table, "d", day(2), day(4))
    found = tables.read_time_range(spark, table, "d date, v string")
    assert rows(found) == [(day(1), "a"), (day(2), "b"), (day(4), "a")]
    assert os.listdir(f"{table}/day=2024-05-04") == untouched
    pruned = tables.read_time_range(spark, table, "d date, v string", day(2), day(4))
    assert rows(pruned) == [(day(2), "b")]
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_time_range_with_no_rows_empties_the_interval(spark, rows, tmp_path):
    table, day = str(tmp_path / "t"), lambda n: dt.date(2024, 5, n)
    df = spark.createDataFrame([(day(1), "a"), (day(2), "a")], "d date, v string")
    tables.write_time_range(df, table, "d", day(1), day(3))
    tables.write_time_range(df.where(F.lit(False)), table, "d", day(2), day(3))
    assert rows(tables.read_time_range(spark, table, "d date, v string")) == [(day(1), "a")]


def test_intermediates_are_removed(spark):
    from daygrain.session import cut, temporary

    with temporary(spark):
        kept = cut(spark.range(5))
        path = kept.inputFiles()[0].removeprefix("file://").removeprefix("file:")
        assert os.path.exists(path) and kept.count() == 5
    assert not os.path.exists(os.path.dirname(path))
