"""Points in intervals: a join on grid cells in place of a comparison of all with all, and figures of the open ones without a join."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, TimestampNTZType, TimestampType

from daygrain.session import cut, ship

#: The start of no interval, as one ends after its start.
NEVER = 2**63 - 1


def whole_number(column: Column, kind: DataType) -> Column:
    """A place on the line as a whole number: microseconds, days or the integer itself."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, TimestampNTZType):
        # By parts, as a cast to an instant would depend on the session's zone.
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.extract(F.lit("SECOND"), column)
        return F.unix_date(column.cast("date")) * F.lit(86_400_000_000) + (seconds * 1_000_000).cast("bigint")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, IntegralType):
        return column.cast("bigint")
    raise TypeError(f"intervals of {kind.simpleString()} are not supported: cast to timestamp, date or an integer")


def from_whole_number(column: Column, kind: DataType) -> Column:
    """The place on the line that ``whole_number`` made a number of."""
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(column)
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_add("MICROSECOND", column, F.expr("timestamp_ntz'1970-01-01'"))
    if isinstance(kind, DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), column.cast("int"))
    return column.cast(kind)


def _same_kind(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str) -> DataType:
    kinds = [df.schema[c].dataType for df, c in ((points, at), (intervals, start), (intervals, end))]
    if len(set(kinds)) > 1:
        raise TypeError(f"{at}, {start} and {end} are of different types: {', '.join(k.simpleString() for k in kinds)}")
    return kinds[0]


def _level(length: Column) -> Column:
    """The cells for an interval: 2 ** level is its length at least and less than four times it."""
    bits = F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
    return (bits + bits % 2).cast("int")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str,
    end: str,
    keys: Mapping[str, str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Pairs of a point and an interval with start <= at < end and equal ``keys`` (column of points to column of intervals).

    ``how`` is inner, or left to keep points that lie in no interval. Times, days and integers are
    supported, of one type on both sides. A NULL bound, place or key, and an interval that ends
    before it starts, match nothing. Columns of both sides come out, so their names must differ.

    An interval of length l lies in cells of a size between l and 4l, of which it touches two at most;
    long ones lie in coarser cells. A point looks into one cell of each size that occurs, of which there
    are 32 at most. The join is on key, size and cell; adaptive execution can split a hot cell.
    The pairs are as many as meet: where many intervals are open at once, ``open_at`` counts them without pairs.
    """
    clash = set(points.columns) & set(intervals.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how}")
    kind = _same_kind(points, intervals, at, start, end)
    keys = keys or {}
    low, high = whole_number(F.col(start), kind), whole_number(F.col(end), kind)
    placed = intervals.withColumns({"__low": low, "__high": high}).where("__low < __high")
    placed = placed.withColumn("__level", _level(F.col("__high") - F.col("__low")))
    first, last = (F.expr(f"shiftright({c}, __level)") for c in ("__low", "__high - 1"))
    placed = cut(placed.withColumn("__cell", F.explode(F.array_distinct(F.array(first, last)))))
    levels = sorted(r["__level"] for r in placed.select("__level").distinct().collect())
    if how == "left":
        points = cut(points.withColumn("__row", F.monotonically_increasing_id()))
    place = whole_number(F.col(at), kind)
    asking = points.withColumn("__at", place).withColumn("__size", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    asking = asking.withColumn("__place", F.expr("shiftright(__at, __size)"))
    same = (F.col("__size") == F.col("__level")) & (F.col("__place") == F.col("__cell"))
    for mine, other in keys.items():
        same = same & (F.col(mine) == F.col(other))
    inside = (F.col("__low") <= F.col("__at")) & (F.col("__at") < F.col("__high"))
    found = asking.join(placed, same & inside).select(*points.columns, *intervals.columns)
    if how == "inner":
        return found
    found = cut(found)
    matched = found.select(F.col("__row").alias("__matched")).distinct()
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema.fields]
    alone = points.join(matched, F.col("__row") == F.col("__matched"), "left_anti").select(*points.columns, *missing)
    return found.unionByName(alone).drop("__row")


def open_at(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, number: str, earliest: str) -> DataFrame:
    """Add to each point the ``number`` of intervals with start <= at < end, and the ``earliest`` of their starts.

    Types, and bounds that match nothing, are those of ``interval_join``. A point in no interval, or
    without a place, has 0 and NULL; rows of points are neither lost nor repeated.

    No pairs are made, of which there are points times intervals where all meet. Points, starts and ends
    are put into one order and cut into ranges of even size; a hot place may be many ranges. Along the
    order the open intervals are those that began less those that ended. Where one is open, the earliest start
    of all that end after the point is the one asked for: those that start after it are later. Each task sweeps
    its range in numpy, and what the other ranges add is one small row for each range.
    """
    clash = {number, earliest} & set(points.columns)
    if clash:
        raise ValueError(f"the points have {sorted(clash)} already")
    kind = _same_kind(points, intervals, at, start, end)
    ship(points.sparkSession)
    place = whole_number(F.col(at), kind)
    bounds = intervals.where(F.col(start) < F.col(end)).select(whole_number(F.col(start), kind).alias("low"), whole_number(F.col(end), kind).alias("high"))
    asking = points.where(F.col(at).isNotNull()).select(place.alias("place"), F.lit(0).cast("tinyint").alias("step"), F.lit(NEVER).alias("since"))
    marks = asking.union(bounds.selectExpr(f"stack(2, low, 1Y, {NEVER}L, high, -1Y, low)"))
    # At equal places points come last: what starts there is open, what ends there is not. Any number parts equal rows.
    marks = marks.withColumns({"asks": F.col("step") == 0, "apart": F.monotonically_increasing_id()})
    ranges = marks.repartitionByRange("place", "asks", "apart").select("place", "step", "since")
    # Stored, because ranges come from a sample: one that is computed again need not be the same.
    swept = cut(ranges.mapInArrow(_swept, "chunk int, place bigint, number bigint, since bigint"))

    # One row for each range.
    along = Window.partitionBy(F.lit(0))
    earlier, later = (along.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("chunk"), F.desc("chunk")))
    others = swept.where("place IS NULL").select(F.col("chunk").alias("of"), F.sum("number").over(earlier).alias("before"), F.min("since").over(later).alias("after"))
    joined = swept.where("place IS NOT NULL").join(cut(others), F.col("chunk") == F.col("of"))
    # A place may have ended one range and begun the next.
    found = joined.groupBy(F.col("place").alias("__place")).agg(
        F.max(F.col("number") + F.coalesce("before", F.lit(0))).alias("__number"), F.min(F.least("since", "after")).alias("__since")
    )
    first = from_whole_number(F.when(F.col("__number") > 0, F.col("__since")), kind)
    counted = points.withColumn("__at", place).join(found, F.col("__at") == F.col("__place"), "left")
    return counted.select(*points.columns, F.coalesce("__number", F.lit(0)).cast("bigint").alias(number), first.alias(earliest))


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of points in a range with the figures inside it, and a row without a place for the whole range."""
    parts = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
    if not parts:
        return
    place, step, since = (np.concatenate(p) for p in zip(*parts))
    del parts
    order = np.lexsort((step == 0, place))
    place, step = place[order], step[order]
    number = np.cumsum(step, dtype=np.int64)
    since = np.minimum.accumulate(since[order][::-1])[::-1]
    asked = np.flatnonzero(step == 0)
    asked = asked[np.unique(place[asked], return_index=True)[1]]
    chunk = TaskContext.get().partitionId()
    for places, rows in ((pa.array(place[asked]), asked), (pa.nulls(1, pa.int64()), None)):
        n, first = (number[rows], since[rows]) if rows is not None else (number[-1:], since[:1])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), chunk, np.int32)), places, pa.array(n), pa.array(first)], ["chunk", "place", "number", "since"])
