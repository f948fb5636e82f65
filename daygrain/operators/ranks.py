"""Ranks over a whole table, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrain.operators.asof import in_even_ranges
from daygrain.session import cut


def global_ranks(df: DataFrame, order: Sequence[str], names: Sequence[str], tiles: int | None = None, descending: Sequence[str] = ()) -> DataFrame:
    """Add columns named in ``names`` as SQL would by OVER (ORDER BY order), columns in ``descending`` from the greatest down.

    row_number, rank, dense_rank, percent_rank, and ntile into ``tiles``. Rows that are equal by
    ``order`` get different row numbers, in no certain order; give a complete order to settle it.

    The rows are stored in ranges of even size along the order, ranked inside their range, and moved on
    by what earlier ranges hold: rows, distinct values, and the place where a run of equal values began
    that reaches over ranges. That is one small row for each range. Equal rows may fill many ranges.
    """
    unknown = set(names) - {"row_number", "rank", "dense_rank", "percent_rank", "ntile"}
    if unknown:
        raise ValueError(f"no such ranks: {sorted(unknown)}")
    if ("ntile" in names) != (tiles is not None) or (tiles is not None and tiles < 1):
        raise ValueError("ntile needs a positive number of tiles, and tiles need ntile")
    own = df.columns
    keyed = df.withColumn("__apart", F.monotonically_increasing_id())
    sort = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    stored = in_even_ranges(keyed, *sort, "__apart", chunk="__chunk").drop("__apart")
    here = Window.partitionBy("__chunk").orderBy(*sort)
    local = {"__row": F.row_number().over(here), "__rank": F.rank().over(here), "__dense": F.dense_rank().over(here)}
    ranked = cut(stored.withColumns(local).withColumn("__value", F.struct(*order)))
    chunks = ranked.groupBy("__chunk").agg(
        F.count("*").alias("n"),
        F.max("__dense").cast("bigint").alias("distinct"),
        F.max("__rank").cast("bigint").alias("last_rank"),
        F.min_by("__value", "__row").alias("first"),
        F.max_by("__value", "__row").alias("last"),
    )
    # One row for each range.
    along = Window.partitionBy(F.lit(0)).orderBy("__chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    up_to = along.rowsBetween(Window.unboundedPreceding, 0)
    chunks = chunks.withColumn("joined", F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(along)) & (F.row_number().over(along) > 1), F.lit(False)))
    chunks = chunks.withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # Where the run of equal values that ends a range began: in the range, or where the run before it did.
    began = F.when((F.col("distinct") > 1) | ~F.col("joined"), F.col("rows_before") + F.col("last_rank"))
    chunks = chunks.withColumn("began", began)
    offsets = cut(
        chunks.select(
            F.col("__chunk").alias("__of"),
            "rows_before",
            "joined",
            (F.coalesce(F.sum("distinct").over(before), F.lit(0)) - F.sum(F.col("joined").cast("bigint")).over(up_to)).alias("dense_before"),
            F.last("began", ignorenulls=True).over(before).alias("run_began"),
            F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"),
        )
    )
    rows = ranked.join(offsets, F.col("__chunk") == F.col("__of"))
    number = F.col("rows_before") + F.col("__row")
    rank = F.when(F.col("joined") & (F.col("__dense") == 1), F.col("run_began")).otherwise(F.col("rows_before") + F.col("__rank"))
    made = {
        "row_number": number,
        "rank": rank,
        "dense_rank": F.col("dense_before") + F.col("__dense"),
        "percent_rank": F.when(F.col("total") > 1, (rank - 1) / (F.col("total") - 1)).otherwise(F.lit(0.0)),
    }
    if tiles:
        made["ntile"] = _tile(number - 1, F.col("total"), tiles)
    return rows.select(*own, *[made[n].alias(n) for n in names])


def _tile(place: Column, total: Column, tiles: int) -> Column:
    """The tile of a row, counted from 0: the first total % tiles tiles hold one row more."""
    share = lambda a, b: F.call_function("div", a, b)
    small, larger = share(total, F.lit(tiles).cast("bigint")), total % tiles
    edge = larger * (small + 1)
    return F.when(place < edge, share(place, small + 1)).otherwise(larger + share(place - edge, F.greatest(small, F.lit(1).cast("bigint")))) + 1
