"""The last row before: as-of joins whose hottest key may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.session import cut


def in_even_ranges(df: DataFrame, *order: Column | str, chunk: str) -> DataFrame:
    """Store the rows in ranges of ``order`` of about equal size and number the ranges in ``chunk``.

    Rows that are equal in ``order`` share a range, unless the caller makes them differ. Stored,
    because ranges come from a sample: a range that is computed again need not be the same.
    """
    return cut(df.repartitionByRange(*order).withColumn(chunk, F.spark_partition_id()))


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Keys agree, NULL with NULL."""
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    left_time: str,
    right_time: str,
    columns: Mapping[str, str],
    ties: Sequence[str] = (),
    strict: bool = False,
    within: Column | None = None,
) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` at or before its time.

    ``keys`` maps columns of ``left`` to those of ``right`` that must be equal; without keys all rows
    are one group. ``columns`` maps names in the result to columns of ``right``; they are NULL where no
    row precedes. Of right rows with the same time the greatest by ``ties`` counts, then the greatest by
    ``columns``. ``strict`` asks for an earlier time; ``within``, an interval, for one that is no longer
    ago. A NULL key or time on either side matches nothing; left rows are neither lost nor repeated.

    Both sides are put into one order by key and time and cut into ranges of even size, so that a hot
    key is many ranges. Inside a range the last right row is looked up by a window; where the range has
    none before, the last one of the key's earlier ranges is carried in: a row for each key and range.
    """
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"the left side has {sorted(clash)} already")
    names = [f"__k{i}" for i in range(len(keys))]
    taken = F.struct(F.col(right_time).alias("__at"), *[F.col(c).alias(n) for n, c in columns.items()])
    tie = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate([*ties, *columns.values()])])
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys.values(), right_time]])
    # At equal times right rows come first, so that they precede the left ones; last, if they must be earlier.
    side = {"left": F.lit(1), "right": F.lit(2 if strict else 0)}
    rows = left.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.col(left_time).alias("__time"),
        side["left"].alias("__side"),
        F.lit(None).cast(right.select(tie).schema[0].dataType).alias("__tie"),
        F.struct(*left.columns).alias("__left"),
        F.lit(None).cast(right.select(taken).schema[0].dataType).alias("__right"),
    ).unionByName(
        right.where(known).select(
            *[F.col(k).alias(n) for k, n in zip(keys.values(), names)],
            F.col(right_time).alias("__time"),
            side["right"].alias("__side"),
            tie.alias("__tie"),
            F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("__left"),
            taken.alias("__right"),
        )
    )
    order = ["__time", "__side", "__tie"]
    # Any number parts left rows of one key and time, whose order among themselves does not matter.
    apart = F.when(F.col("__side") == 1, F.monotonically_increasing_id()).otherwise(0)
    stored = in_even_ranges(rows.withColumn("__apart", apart), *names, *order, "__apart", chunk="__chunk").drop("__apart")

    here = Window.partitionBy(*names, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = stored.withColumn("__here", F.last("__right", ignorenulls=True).over(here)).where("__side = 1")
    last = stored.groupBy(*names, "__chunk").agg(F.max_by("__right", F.when(F.col("__side") != 1, F.struct("__time", "__tie"))).alias("__last"))
    earlier = Window.partitionBy(*(names or [F.lit(0)])).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("__before", F.last("__last", ignorenulls=True).over(earlier)).where("__before IS NOT NULL")
    carried = cut(carried.select(*[F.col(n).alias(f"{n}_of") for n in names], F.col("__chunk").alias("__chunk_of"), "__before"))
    joined = found.join(carried, same_keys([*names, "__chunk"], [*[f"{n}_of" for n in names], "__chunk_of"]), "left")
    match = F.coalesce("__here", "__before")
    fits = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names], F.col("__time").isNotNull())
    if within is not None:
        fits = fits & (match["__at"] >= F.col("__time") - within)
    joined = joined.select("__left", F.when(fits, match).alias("__match"))
    return joined.select("__left.*", *[F.col(f"__match.{n}").alias(n) for n in columns])
