"""Stored states of aggregates: kept for each day, merged for any range of days, without reading rows again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.session import cut

#: Size of a quantile state; its ranks are off by 1.33 % of the rows or less, in 99 of 100 cases.
KLL_K = 200
RANK_ERROR = 0.0133
#: Registers of a distinct-count state are 2 ** this; its count is off by 1.04 / sqrt(2 ** this) in standard deviations.
HLL_LG_K = 14


def day_states(df: DataFrame, groups: Sequence[str], day: Column, values: Mapping[str, str], ids: Mapping[str, str]) -> DataFrame:
    """(groups, day, n, states): a row for each group and day, to be stored and merged.

    ``values`` maps names to number columns whose quantiles are wanted (doubles), ``ids`` names to columns whose
    distinct values are to be counted. NULLs are in no state, NaN in no quantile. A state is some kilobytes at
    most, whatever the number of rows, and is built before anything is shuffled.
    """
    plain = {n: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for n, c in values.items()}
    return df.groupBy(*groups, day.alias("day")).agg(
        F.count("*").alias("n"),
        *[F.kll_sketch_agg_double(c, F.lit(KLL_K)).alias(n) for n, c in plain.items()],
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_LG_K)).alias(n) for n, c in ids.items()],
    )


def over_days(states: DataFrame, groups: Sequence[str], first: Column, last: Column, values: Mapping[str, Sequence[float]], ids: Sequence[str]) -> DataFrame:
    """(groups, n, quantiles, counts) of the days from ``first`` to ``last``, both included, from states only.

    ``values`` maps a quantile state to the shares wanted; each comes out as an array of that name, which is
    NULL where no row had a value. ``ids`` names distinct-count states; each comes out as its count.
    """
    merged = states.where(F.col("day").between(first, last)).groupBy(*groups).agg(
        F.sum("n").alias("n"),
        *[F.kll_merge_agg_double(n).alias(n) for n in values],
        *[F.hll_union_agg(n).alias(n) for n in ids],
    )
    quantiles = []
    for name, shares in values.items():
        found = F.kll_sketch_get_quantile_double(name, F.array(*[F.lit(float(s)) for s in shares]))
        quantiles.append(F.when(F.kll_sketch_get_n_double(name) > 0, found).alias(name))
    return merged.select(*groups, "n", *quantiles, *[F.hll_sketch_estimate(n).alias(n) for n in ids])


def bitmap_states(df: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """(groups, bucket, bitmap): which whole numbers occur in each group, as bitmaps of 32,768 numbers. NULL is none.

    Good for numbers that lie close together, such as keys given out in turn: a bucket is 4 KB, however few its numbers.
    """
    seen = df.where(F.col(number).isNotNull())
    return seen.groupBy(*groups, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def rolled_up(states: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Exact distinct counts for every prefix of ``groups``, as GROUP BY ROLLUP gives them: (groups, level, name).

    ``level`` is the number of groups that count; the others are NULL. Each level is or-ed from the one below
    it, bitmap by bitmap: no row of the data is read again or multiplied. Without any number the result is
    the one row of the empty level, with 0.
    """
    out = []
    level = states
    for depth in range(len(groups), -1, -1):
        kept = groups[:depth]
        if depth < len(groups):
            level = level.groupBy(*kept, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        level = cut(level)
        counted = level.groupBy(*kept).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))
        nulls = [F.lit(None).cast(states.schema[g].dataType).alias(g) for g in groups[depth:]]
        out.append(counted.select(*kept, *nulls, F.lit(depth).alias("level"), F.col(name).cast("bigint").alias(name)))
    return reduce(DataFrame.unionByName, out)
