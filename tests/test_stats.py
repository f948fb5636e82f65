"""Statistics against closed forms and plain loops."""

import math
import operator
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daygrain.operators import stats


def test_correlation_without_spread_or_pairs_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0, None), (2.0, 4.0, 7.0, None), (3.0, 7.0, None, 1.0)], "a double, b double, c double, d double")
    found = {(r.x, r.y): r.r for r in stats.correlation_matrix(df, ["a", "b", "c", "d"], 6).collect()}
    assert len(found) == 6 and found[("b", "a")] == pytest.approx(0.993399, abs=1e-6)
    assert all(v is None for k, v in found.items() if k != ("b", "a"))
    assert df.agg(stats.safe_corr(F.col("a"), F.col("c")).alias("r")).first().r is None


@pytest.mark.parametrize("pairs,r,band", [([(1, 1), (2, 2)], 1.0, "strong"), ([(1, 1), (2, -1), (3, 1), (4, -1)], -0.447, "moderate"), ([(1, 0), (1, 1)], None, None)])
def test_correlation_band(spark, pairs, r, band):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "a double, b double")
    assert tuple(stats.correlation_band(df, "a", "b").first()) == (r, band)


def test_linear_fit_swaps_axes(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i + 2.0) for i in range(5)] + [(None, 1.0)], "x double, y double")
    line, turned = stats.linear_fit(df, "x", "y").first(), stats.linear_fit(df, "x", "y", swap=True).first()
    assert line.asDict() == pytest.approx({"slope": 3.0, "intercept": 2.0, "r2": 1.0, "n": 5})
    assert turned.slope == pytest.approx(1 / 3) and turned.intercept == pytest.approx(-2 / 3)


def test_logistic_fit_of_two_groups_has_a_closed_form(spark):
    found = [(0.0, 1)] * 3 + [(0.0, 0)] * 9 + [(1.0, 1)] * 8 + [(1.0, 0)] * 4 + [(None, 1), (1.0, None)]
    fit = stats.logistic_fit(spark.createDataFrame(found, "x double, y int"), "x", "y").first()
    assert fit.intercept == pytest.approx(math.log(3 / 9), abs=1e-6)
    assert fit.slope == pytest.approx(math.log(8 / 4) - math.log(3 / 9), abs=1e-6)


def test_conditional_means_and_records(spark):
    found = [(90.0, 80.0, 60.0, 62.0, 0.0, 4.0, "win"), (70.0, 80.0, 65.0, 62.0, 1.0, 2.0, "loss"), (70.0, 80.0, None, 62.0, 2.0, 3.0, "tie")]
    df = spark.createDataFrame(
        found, "max_temp_deg_f double, avg_max_temp_deg_f double, min_temp_deg_f double, avg_min_temp_deg_f double, total_precip_inches double, rate double, team_outcome string"
    )
    means = {r.condition: (r["mean"], r.delta) for r in stats.conditional_means(df, {"rate": "rate"}, stats.weather_conditions()).collect()}
    assert means == {"all": (3.0, None), "hot": (4.0, 1.0), "cold": (4.0, 1.0), "rainy": (2.5, -0.5)}
    record = {r.condition: (r.wins, r.losses, r.win_pct, r.delta) for r in stats.win_loss_record(df, stats.weather_conditions(rainy=operator.gt)).collect()}
    # Exactly one inch counts for means only; no decided game under a condition has no share.
    assert record == {"all": (1, 1, 0.5, None), "hot": (1, 0, 1.0, 0.5), "cold": (1, 0, 1.0, 0.5), "rainy": (0, 0, None, None)}


def test_bootstrap_band_is_repeatable_and_encloses_the_line(spark, rows):
    source = random.Random(3)
    found = [(i, float(i % 40), 2.0 * (i % 40) + source.gauss(0, 5)) for i in range(400)]
    df = spark.createDataFrame(found, "id int, x double, y double")
    band = stats.bootstrap_band(df, "x", "y", ["id"], replicates=200, points=5, seed=1)
    first = sorted(rows(band))
    again = sorted(rows(stats.bootstrap_band(df.repartition(7), "x", "y", ["id"], replicates=200, points=5, seed=1)))
    assert [v for r in again for v in r] == pytest.approx([v for r in first for v in r])
    line = stats.linear_fit(df, "x", "y").first()
    for x, fit, low, high in first:
        assert fit == pytest.approx(line.intercept + line.slope * x) and low < fit < high
        assert high - low < 3.0
    assert [r[0] for r in first] == pytest.approx([0.0, 9.75, 19.5, 29.25, 39.0])


def test_poisson_draws_have_mean_and_variance_one():
    even = np.searchsorted(stats.poisson_limits(), np.arange(200000) * stats.PRIME // 200000, "right")
    assert even.mean() == pytest.approx(1.0, abs=1e-3) and even.var() == pytest.approx(1.0, abs=1e-3)


def test_draws_differ_between_rows_and_replicates():
    """Sums of weights of rows that are only numbered: as uneven over replicates and rows as independent draws."""
    rows = pa.RecordBatch.from_arrays([pa.array(np.ones(500)), pa.array(np.ones(500)), pa.array(np.arange(19000, 19500))], ["a", "b", "row"])
    (sums,) = stats._resampled(1000, 0)([rows])
    n = sums.column("n").to_numpy()
    assert n[0] == 500 and n[1:].mean() == pytest.approx(500, abs=4) and n[1:].var() == pytest.approx(500, rel=0.25)
    one = pa.RecordBatch.from_arrays([pa.array([1.0]), pa.array([1.0]), pa.array([19000])], ["a", "b", "row"])
    first, other = (next(stats._resampled(5000, seed)([one])).column("n").to_numpy()[1:] for seed in (0, 1))
    assert first.mean() == pytest.approx(1, abs=0.08) and first.var() == pytest.approx(1, abs=0.15)
    assert abs(np.corrcoef(first, other)[0, 1]) < 0.06 and abs(np.corrcoef(first[1:], first[:-1])[0, 1]) < 0.06


def test_most_frequent_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,), (None,), (None,)], "v string")
    assert stats.most_frequent(df, "v").first().v == "a"


def test_presence_extent_and_calendar(spark):
    df = spark.createDataFrame([(None, 0, 3), (None, 0, 4)], "a int, b int, c int")
    assert stats.presence(df, {"a": "a", "c": "c"}, {"b": "b"}).first().asDict() == {"a": False, "c": True, "b": False}
    assert tuple(stats.extent(df, "c").first()) == (3, 4)
    days = stats.calendar(spark, 2024)
    assert days.count() == 366 and days.orderBy("day").first().label == "2024-01-01"
