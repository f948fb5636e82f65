"""Statistics over day tables: one pass each, small results."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.columns import absent_nan, round_to
from daygrain.session import cut, ship

Conditions = Mapping[str, Column]
#: Fixed value: 95 % of a normal distribution lie within so many standard deviations.
NORMAL_95 = 1.959963984540054


def number(column: str | Column) -> Column:
    """A double; NaN counts as absent, like NULL."""
    return absent_nan((F.col(column) if isinstance(column, str) else column).cast("double"))


# --- conditions -------------------------------------------------------------


def weather_conditions(rain: float = 1.0, rainy: Callable = operator.ge) -> dict[str, Column]:
    """Hot, cold and rainy days. Means use ``>=`` one inch, records ``>``."""
    return {
        "hot": F.col("max_temp_deg_f") > F.col("avg_max_temp_deg_f"),
        "cold": F.col("min_temp_deg_f") < F.col("avg_min_temp_deg_f"),
        "rainy": rainy(F.col("total_precip_inches"), F.lit(rain)),
    }


def team_conditions(streak: int = 4) -> dict[str, Column]:
    """Record above and below even, long winning and losing streaks."""
    wins, losses = F.col("team_current_record_wins_lag"), F.col("team_current_record_losses_lag")
    return {
        "above_500": wins > losses,
        "below_500": wins < losses,
        "winning_streak": F.col("team_current_streak") >= streak,
        "losing_streak": F.col("team_current_streak") <= -streak,
    }


# --- summaries --------------------------------------------------------------


def extent(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value, the smallest of equally frequent ones. NULL does not count.

    Counts are aggregated before one row is chosen, so no task holds all values.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return counts.orderBy(F.col("__n").desc(), F.col(column).asc()).limit(1).select(column)


def presence(df: DataFrame, counted: Mapping[str, str], summed: Mapping[str, str]) -> DataFrame:
    """Which groups of fields hold data: non-NULL count or non-zero sum, one boolean each."""
    tests = [(F.count(c) > 0).alias(name) for name, c in counted.items()]
    tests += [F.coalesce(F.sum(number(c)) != 0, F.lit(False)).alias(name) for name, c in summed.items()]
    return df.agg(*tests)


def conditional_means(df: DataFrame, metrics: Mapping[str, str], conditions: Conditions) -> DataFrame:
    """Mean of each metric overall and under each condition, with the difference.

    All of it is one aggregation; the single wide row is then turned into
    (metric, condition, mean, delta).
    """
    cells = [F.avg(number(c)).alias(f"{i}__all") for i, c in enumerate(metrics.values())]
    for name, condition in conditions.items():
        cells += [F.avg(F.when(condition, number(c))).alias(f"{i}__{name}") for i, c in enumerate(metrics.values())]
    wide = df.agg(*cells)
    rows = []
    for i, metric in enumerate(metrics):
        overall = F.col(f"{i}__all")
        rows.append(F.struct(F.lit(metric).alias("metric"), F.lit("all").alias("condition"), round_to(overall, 2).alias("mean"), F.lit(None).cast("double").alias("delta")))
        for name in conditions:
            mean = F.col(f"{i}__{name}")
            rows.append(F.struct(F.lit(metric).alias("metric"), F.lit(name).alias("condition"), round_to(mean, 2).alias("mean"), round_to(mean - overall, 2).alias("delta")))
    return wide.select(F.inline(F.array(*rows)))


def win_loss_record(df: DataFrame, conditions: Conditions, outcome: str = "team_outcome") -> DataFrame:
    """Wins, losses and win share overall and under each condition, with the difference.

    No games under a condition give NULL instead of a division by zero.
    """
    tests = {"all": F.lit(True), **conditions}
    counts = []
    for name, condition in tests.items():
        counts += [F.count_if(condition & (F.col(outcome) == o)).alias(f"{name}__{o}") for o in ("win", "loss")]
    wide = df.agg(*counts)

    def share(name: str) -> Column:
        wins, losses = F.col(f"{name}__win"), F.col(f"{name}__loss")
        return round_to(F.try_divide(wins.cast("double"), (wins + losses).cast("double")), 3)

    rows = [
        F.struct(
            F.lit(name).alias("condition"),
            F.col(f"{name}__win").alias("wins"),
            F.col(f"{name}__loss").alias("losses"),
            share(name).alias("win_pct"),
            (F.lit(None).cast("double") if name == "all" else round_to(share(name) - share("all"), 3)).alias("delta"),
        )
        for name in tests
    ]
    return wide.select(F.inline(F.array(*rows)))


# --- relations --------------------------------------------------------------


_PAIR_NAMES = ["i", "j", "n", "x_sum", "y_sum", "x_squares", "y_squares", "product_sum", "x_low", "x_high", "y_low", "y_high"]


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson over complete pairs; NULL without spread (ANSI ``corr`` would raise). NaN is absent."""
    x, y = number(x), number(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per Arrow batch and pair of columns: count, sums, products and extremes over complete pairs."""
    for batch in batches:
        x = np.column_stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])
        known = ~np.isnan(x)
        mask, zeroed = known.astype(float), np.where(known, x, 0.0)
        n, s, ss, products = mask.T @ mask, zeroed.T @ mask, (zeroed**2).T @ mask, zeroed.T @ zeroed
        # lowest[i, j] and highest[i, j]: extremes of column i where column j is known too.
        lowest = np.array([np.where(known & known[:, [i]], x[:, [i]], np.inf).min(0, initial=np.inf) for i in range(x.shape[1])])
        highest = np.array([np.where(known & known[:, [i]], x[:, [i]], -np.inf).max(0, initial=-np.inf) for i in range(x.shape[1])])
        i, j = np.tril_indices(x.shape[1], -1)
        cells = [i.astype(np.int32), j.astype(np.int32), n[i, j], s[i, j], s[j, i], ss[i, j], ss[j, i], products[i, j]]
        cells += [lowest[i, j], highest[i, j], lowest[j, i], highest[j, i]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=_PAIR_NAMES)


def correlation_matrix(df: DataFrame, fields: Sequence[str], digits: int = 2) -> DataFrame:
    """Strict lower triangle as (x, y, r), pairwise complete; NULL without pairs or spread.

    Fifteen fields make 105 pairs. Folding every row into every pair with SQL aggregates
    costs over ten times the matrix products used here. Values are centred first, by one
    cheap aggregation, so that plain sums lose no digits. A batch leaves one row per pair,
    folded again per task before it is shuffled.
    """
    ship(df.sparkSession)
    # The numbers alone are stored, so that the input is evaluated once for the means and the products.
    numbers = cut(df.select(*[number(c).alias(f"f{i}") for i, c in enumerate(fields)]))
    means = numbers.agg(F.struct(*[F.avg(c).alias(c) for c in numbers.columns])).scalar()
    held = numbers.select("*", means.alias("m"))
    centred = held.select(*[(F.col(f"f{i}") - F.col(f"m.f{i}")).alias(f"f{i}") for i in range(len(fields))])
    schema = "i int, j int, " + ", ".join(f"{n} double" for n in _PAIR_NAMES[2:])
    total = centred.mapInArrow(_pair_sums, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in _PAIR_NAMES[2:8]],
        ((F.min("x_low") < F.max("x_high")) & (F.min("y_low") < F.max("y_high"))).alias("spread"),
    )
    n, sx, sy = F.col("n"), F.col("x_sum"), F.col("y_sum")
    above = n * F.col("product_sum") - sx * sy
    squares = [F.greatest(n * F.col(f"{v}_squares") - v_sum * v_sum, F.lit(0.0)) for v, v_sum in (("x", sx), ("y", sy))]
    below = F.sqrt(squares[0]) * F.sqrt(squares[1])
    names = F.array(*[F.lit(c) for c in fields])
    r = F.when(F.col("spread"), round_to(F.try_divide(above, below), digits))
    cells = total.select("i", "j", r.alias("r"))
    # An empty input still has its cells.
    wanted = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for j, i in combinations(range(len(fields)), 2)]
    triangle = df.sparkSession.range(1).select(F.inline(F.array(*wanted)))
    return triangle.join(cells, ["i", "j"], "left").select(F.get(names, F.col("i")).alias("x"), F.get(names, F.col("j")).alias("y"), "r")


def correlation_band(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of one pair and how strong it is."""
    r = F.abs("r")
    band = F.when(r < 0.3, F.lit("weak")).when(r < 0.7, F.lit("moderate")).when(r.isNotNull(), F.lit("strong"))
    return df.agg(round_to(safe_corr(F.col(x), F.col(y)), 3).alias("r")).withColumn("band", band)


def linear_fit(df: DataFrame, x: str, y: str, swap: bool = False) -> DataFrame:
    """Least-squares line of y on x (or of x on y)."""
    if swap:
        x, y = y, x
    a, b = number(y), number(x)
    return df.agg(
        F.regr_slope(a, b).alias("slope"),
        F.regr_intercept(a, b).alias("intercept"),
        F.regr_r2(a, b).alias("r2"),
        F.regr_count(a, b).alias("n"),
    )


def linear_fits(df: DataFrame, x: str, y: str) -> DataFrame:
    """Both least-squares lines of a pair from one aggregate: (axes, slope, intercept, r2, n)."""
    a, b = number(y), number(x)
    lines = []
    for axes, up, along in (("y on x", a, b), ("x on y", b, a)):
        figures = {"slope": F.regr_slope, "intercept": F.regr_intercept, "r2": F.regr_r2, "n": F.regr_count}
        lines.append(F.struct(F.lit(axes).alias("axes"), *[f(up, along).alias(name) for name, f in figures.items()]))
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def means_at(df: DataFrame, x: str, y: str) -> DataFrame:
    """Mean of y at each distinct x with its 95 % interval, over complete pairs; NaN is absent.

    The interval is that of the normal distribution about the mean; a single row has none.
    """
    complete = df.where(number(x).isNotNull() & number(y).isNotNull())
    found = complete.groupBy(F.col(x).alias("x")).agg(F.avg(number(y)).alias("mean_y"), F.count(F.lit(1)).alias("n"), F.stddev_samp(number(y)).alias("__s"))
    half = F.when(F.col("n") > 1, NORMAL_95 * F.col("__s") / F.sqrt("n"))
    return found.select("x", "mean_y", "n", (F.col("mean_y") - half).alias("low"), (F.col("mean_y") + half).alias("high"))


def logistic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Unpenalised logistic regression of a 0/1 column: (intercept, slope, classes, converged), one row.

    The rows are folded to counts of (x, y) first, so the iterations never go back to the source.
    There is no finite fit, and both coefficients are NULL, without rows of both classes, without
    spread in x, and where a value of x parts the classes; ``converged`` is then false.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    pairs = df.select(number(x).alias("x"), number(y).alias("label")).dropna()
    counts = cut(pairs.groupBy("x", "label").agg(F.count(F.lit(1)).cast("double").alias("n")))
    sides = {r["label"]: (r["low"], r["high"]) for r in counts.groupBy("label").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("label").limit(3).collect()}
    schema = "intercept double, slope double, classes int, converged boolean"
    parted = len(sides) != 2 or sides[0.0][1] <= sides[1.0][0] or sides[1.0][1] <= sides[0.0][0]
    if parted:
        return df.sparkSession.createDataFrame([(None, None, len(sides), False)], schema)
    points = VectorAssembler(inputCols=["x"], outputCol="features").transform(counts)
    model = GeneralizedLinearRegression(family="binomial", link="logit", weightCol="n", regParam=0.0, maxIter=50, tol=1e-10).fit(points)
    found = (float(model.intercept), float(model.coefficients[0]), 2, model.summary.numIterations < 50)
    return df.sparkSession.createDataFrame([found], schema)


#: Draws are made modulo this prime, so that products stay below 2 ** 62.
PRIME = 2**31 - 1
#: Rows whose weights for all replicates are held at a time, in draws.
DRAWS = 1 << 20


def bootstrap_band(
    df: DataFrame,
    x: str,
    y: str,
    key: Sequence[str],
    replicates: int = 1000,
    points: int = 100,
    seed: int = 0,
    level: float = 0.95,
    number_of_row: Column | None = None,
) -> DataFrame:
    """Fitted line with a bootstrap band at evenly spaced x: (x, fit, low, high).

    Replicates weigh rows by Poisson(1) draws. A draw depends on the row's ``key`` (its hash, or
    ``number_of_row``, a whole number), the replicate and the seed only, in whole numbers, so a lost
    task repeats it exactly and any engine can. Each task folds its rows into five sums for each
    replicate, by one product of weights and terms for each slice of a batch. Where all x are equal there
    is no line, and the one row of that x has NULLs.
    """
    ship(df.sparkSession)
    row = F.xxhash64(*key) if number_of_row is None else number_of_row
    pairs = df.where(number(x).isNotNull() & number(y).isNotNull()).select(
        number(x).alias("x"), number(y).alias("y"), F.pmod(row.cast("bigint"), F.lit(PRIME)).cast("bigint").alias("row")
    )
    # About its centre a line loses no digits, however far from zero the data lie.
    facts = pairs.agg(F.struct(F.avg("x").alias("x"), F.avg("y").alias("y"), F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    centred = pairs.withColumn("facts", facts).select((F.col("x") - F.col("facts.x")).alias("a"), (F.col("y") - F.col("facts.y")).alias("b"), "row")
    terms = ("n", "sx", "sy", "sxx", "sxy")
    folded = centred.mapInArrow(_resampled(replicates, seed), "replicate int, " + ", ".join(f"{t} double" for t in terms))
    sums = folded.groupBy("replicate").agg(*[F.sum(t).alias(t) for t in terms])
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    lines = sums.select("replicate", slope.alias("slope"), F.try_divide(F.col("sy") - slope * F.col("sx"), F.col("n")).alias("intercept"))
    ranged = lines.withColumn("facts", facts)
    ranged = ranged.withColumn("step", (F.col("facts.high") - F.col("facts.low")) / F.lit(float(points - 1)))
    steps = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("facts.low") + F.col("step") * i)
    predicted = ranged.select("replicate", "slope", "intercept", "facts", F.explode(steps).alias("x"))
    predicted = predicted.withColumn("value", F.col("facts.y") + F.col("intercept") + F.col("slope") * (F.col("x") - F.col("facts.x")))
    tail = (1.0 - level) / 2.0
    resampled = F.when(F.col("replicate") > 0, F.col("value"))
    return predicted.groupBy("x").agg(
        F.max(F.when(F.col("replicate") == 0, F.col("value"))).alias("fit"),
        F.percentile(resampled, F.lit(tail)).alias("low"),
        F.percentile(resampled, F.lit(1.0 - tail)).alias("high"),
    )


def _resampled(replicates: int, seed: int):
    """Sums for each replicate over a task's rows; replicate 0 is the data itself."""
    limits, start = poisson_limits(), draw_start(seed)

    def run(batches):
        number_of = np.arange(1, replicates + 1, dtype=np.int64)
        sums = np.zeros((replicates + 1, 5))
        seen = False
        for batch in batches:
            a, b, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "row"))
            step = max(1, DRAWS // max(1, replicates))
            for at in range(0, len(row), step):
                u, v = a[at : at + step], b[at : at + step]
                terms = np.stack((np.ones(len(u)), u, v, u * u, u * v), axis=1)
                draws = (row[at : at + step, None] * 48271 + number_of * 16807 + start) % PRIME
                for _ in range(3):
                    draws = (draws * draws + draws * 69621 + 12345) % PRIME
                weights = np.searchsorted(limits, draws.ravel(), "right").reshape(draws.shape)
                sums[0] += terms.sum(axis=0)
                sums[1:] += weights.T.astype(np.float64) @ terms
                seen = True
        if seen:
            columns = [pa.array(np.arange(replicates + 1, dtype=np.int32)), *[pa.array(sums[:, k]) for k in range(5)]]
            yield pa.RecordBatch.from_arrays(columns, ["replicate", "n", "sx", "sy", "sxx", "sxy"])

    return run


def draw_start(seed: int) -> int:
    return seed * 40692 % PRIME


def poisson_limits() -> list[int]:
    """A draw in [0, PRIME) is a Poisson(1) number: how many of these it reaches."""
    share, total, limits, k = 2.718281828459045**-1, 0.0, [], 0
    while total + share > total and int((total + share) * PRIME) < PRIME - 1:
        total += share
        limits.append(int(total * PRIME))
        k += 1
        share /= k
    return limits


def calendar(spark, year: int) -> DataFrame:
    """Every day of a year with its text."""
    first, last = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))
    return days.withColumn("label", F.date_format("day", "yyyy-MM-dd"))
