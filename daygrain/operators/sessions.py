"""Sessions: runs of rows of a key without a long gap between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.operators.asof import in_even_ranges, same_keys
from daygrain.operators.intervals import whole_number
from daygrain.session import cut


def with_sessions(df: DataFrame, keys: Sequence[str], time: str, gap: int, name: str = "session") -> DataFrame:
    """Number the sessions of each key 1, 2, 3 … in ``name``.

    A row begins a session if ``gap`` or more has passed since the row before it: microseconds for
    timestamps, days for dates, units for integers. Rows of equal time share a session; NULL keys form a group; a row
    without a time has no session.

    Rows are stored in ranges of even size along key and time. Inside a range a window compares each row
    with the one before; the last time and the number of sessions of a key's earlier ranges are carried
    into its next ones, as a row for each key and range that is not the key's first.
    """
    if gap < 1:
        raise ValueError("a gap is positive")
    names = [f"__k{i}" for i in range(len(keys))]
    at = whole_number(F.col(time), df.schema[time].dataType)
    placed = df.withColumns({**{n: F.col(k) for n, k in zip(names, keys)}, "__at": at, "__apart": F.monotonically_increasing_id()})
    stored = in_even_ranges(placed, *names, "__at", "__apart", chunk="__chunk").drop("__apart")
    here = Window.partitionBy(*names, "__chunk").orderBy("__at")
    begins = F.col("__at") - F.lag("__at").over(here) >= gap
    begun = cut(stored.withColumn("__begins", F.coalesce(begins, F.lit(False)).cast("bigint")))

    chunks = begun.groupBy(*names, "__chunk").agg(F.min("__at").alias("first"), F.max("__at").alias("last"), F.sum("__begins").alias("n"))
    along = Window.partitionBy(*(names or [F.lit(0)])).orderBy("__chunk")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    since = F.col("first") - F.last("last", ignorenulls=True).over(earlier)
    # The first row of a range begins a session too, unless an earlier range ends shortly before it.
    chunks = chunks.withColumn("opens", F.when(F.col("first").isNotNull() & (since.isNull() | (since >= gap)), 1).otherwise(0).cast("bigint"))
    before = F.coalesce(F.sum(F.col("n") + F.col("opens")).over(earlier), F.lit(0)) + F.col("opens")
    carried = chunks.select(*[F.col(c).alias(f"{c}_of") for c in [*names, "__chunk"]], before.alias("__before")).where("__before <> 1")
    joined = begun.join(cut(carried), same_keys([*names, "__chunk"], [f"{c}_of" for c in [*names, "__chunk"]]), "left")
    running = F.sum("__begins").over(here.rangeBetween(Window.unboundedPreceding, 0))
    number = F.when(F.col("__at").isNotNull(), F.coalesce("__before", F.lit(1)) + running)
    return joined.withColumn("__number", number).select(*df.columns, F.col("__number").alias(name))


def session_table(df: DataFrame, keys: Sequence[str], time: str, gap: int, made: Mapping[str, Column]) -> DataFrame:
    """A row for each session: keys, session, started, ended, n, and the aggregates of ``made``. Rows without a time are in none."""
    found = with_sessions(df, keys, time, gap).where(F.col("session").isNotNull())
    return found.groupBy(*keys, "session").agg(
        F.min(time).alias("started"), F.max(time).alias("ended"), F.count("*").alias("n"), *[c.alias(n) for n, c in made.items()]
    )
