"""Frames by value: aggregates over the last so many days of a key, whatever its number of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.operators.asof import in_even_ranges, same_keys
from daygrain.operators.intervals import whole_number
from daygrain.session import cut

#: How partial results of an aggregate are put together.
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
BOTH = {"sum": lambda a, b: F.coalesce(a + b, a, b), "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "min": F.least, "max": F.greatest}
START = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def over_last(df: DataFrame, keys: Sequence[str], time: str, width: int, made: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add aggregates over RANGE BETWEEN ``width`` PRECEDING AND CURRENT ROW of each key, ordered by ``time``.

    ``made`` maps a new column to (sum, count, min or max; column). ``width`` is in microseconds
    for timestamps, in days for dates and in units for integers, both ends included. Rows of equal
    time see each other. NULL keys form a group, rows without a time a frame of their own. Sums of
    doubles may differ in the last digits from those in another order; cast to decimal for exact ones.

    Time is cut into blocks as long as the frame. A frame ends in one block and begins in the one
    before it: it is a prefix of the one and a suffix of the other. Rows of equal key and time are one
    row first. Blocks are stored in ranges of even size, running aggregates start anew in each range,
    and what a block's other ranges add is one small row each, so that neither a hot key nor a hot
    block is in one task. Nothing is subtracted: any aggregate that can be merged works.
    """
    unknown = {how for how, _ in made.values()} - set(MERGE)
    if unknown or width < 1:
        raise ValueError(f"unknown aggregates {sorted(unknown)}" if unknown else "a frame has a positive width")
    kind = df.schema[time].dataType
    at = whole_number(F.col(time), kind)
    names = [f"__k{i}" for i in range(len(keys))]
    placed = df.withColumns({**{n: F.col(k) for n, k in zip(names, keys)}, "__at": at})
    parts = [f"__part_{n}" for n in made]
    moments = placed.groupBy(*names, "__at").agg(*[START[how](c).alias(p) for (how, c), p in zip(made.values(), parts)])
    kinds = {p: moments.schema[p].dataType for p in parts}
    # Beside each moment a probe where its frame begins; a probe has no value, and stands for its moment.
    moments = moments.withColumn("__probe", F.explode(F.array(F.lit(False), F.lit(True)))).where("NOT __probe OR __at IS NOT NULL")
    place = F.when(F.col("__probe"), F.col("__at") - width).otherwise(F.col("__at"))
    empty = {p: F.when(~F.col("__probe"), F.col(p)) for p in parts}
    moments = moments.withColumns({"__place": place, **empty}).withColumn("__block", _block(F.col("__place"), width))
    # At one place the probe comes first: its frame begins with the moment there.
    order = ["__place", "__probe_last"]
    moments = moments.withColumn("__probe_last", F.when(F.col("__probe"), 0).otherwise(1))
    group = [*names, "__block"]
    stored = in_even_ranges(moments, *group, *order, chunk="__chunk")

    inside = Window.partitionBy(*group, "__chunk")
    forward = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # Backwards in the order from the end: to a frame that ends at UNBOUNDED FOLLOWING Spark adds all its rows anew for each row.
    backward = inside.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    hows = [how for how, _ in made.values()]
    seen = stored.withColumns({p: F.when(F.col("__probe"), MERGE[h](p).over(backward)).otherwise(MERGE[h](p).over(forward)) for h, p in zip(hows, parts)})

    chunks = stored.groupBy(*group, "__chunk").agg(*[MERGE[h](p).alias(p) for h, p in zip(hows, parts)])
    along = Window.partitionBy(*group)
    earlier, later = (along.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("__chunk"), F.desc("__chunk")))
    others = chunks.select(
        *[F.col(c).alias(f"{c}_of") for c in [*group, "__chunk"]],
        *[MERGE[h](p).over(w).alias(f"{p}_{side}") for h, p in zip(hows, parts) for side, w in (("before", earlier), ("after", later))],
        F.count("*").over(Window.partitionBy(*group)).alias("__chunks"),
    )
    # Only blocks of several ranges have something to carry.
    others = cut(others.where("__chunks > 1").drop("__chunks"))
    joined = seen.join(others, same_keys([*group, "__chunk"], [f"{c}_of" for c in [*group, "__chunk"]]), "left")
    whole = {p: BOTH[h](F.col(p), F.when(F.col("__probe"), F.col(f"{p}_after")).otherwise(F.col(f"{p}_before"))) for h, p in zip(hows, parts)}
    halves = joined.withColumns(whole).groupBy(*names, "__at").agg(
        *[F.max(F.when(F.col("__probe") == side, F.col(p))).alias(f"{p}_{side}") for p in parts for side in (False, True)]
    )
    frames = halves.select(
        *[F.col(c).alias(f"{c}_of") for c in [*names, "__at"]],
        *[BOTH[h](F.col(f"{p}_False"), F.col(f"{p}_True")).cast(kinds[p]).alias(n) for h, p, n in zip(hows, parts, made)],
    )
    return placed.join(frames, same_keys([*names, "__at"], [f"{c}_of" for c in [*names, "__at"]])).select(*df.columns, *made)


def _block(place: Column, width: int) -> Column:
    """place // width, for places below zero too."""
    return F.call_function("div", place - F.pmod(place, F.lit(width).cast("bigint")), F.lit(width).cast("bigint"))
