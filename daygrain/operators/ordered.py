"""Ordered windows over groups of any size.

A plain running window puts each group into one task. Here a group is cut into
chunks along its order: windows run inside chunks, and what earlier chunks
contribute is one small row per chunk. The planner knows its size: it is broadcast
under the session's threshold and joined by shuffle beyond it. Where every group fits
one chunk it is empty and adaptive execution drops the join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daygrain.session import cut

# Rows a window may hold per group and task. Larger chunks mean fewer rows carried between them.
CHUNK_ROWS = 1 << 18


def number_chunk(number: Column, day: Column, rows: int = CHUNK_ROWS) -> Column:
    """Chunk of a dense sequence number; rows without a number come last, by day."""
    behind = F.lit(1 << 40) + F.unix_date(day)
    return F.coalesce(F.floor(number / F.lit(rows)).cast("bigint"), behind)


def running_counts(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[Column],
    counts: Mapping[str, Column],
) -> DataFrame:
    """Add running counts (rows up to this one that pass a test) per group of ``keys``.

    ``chunk`` must not decrease along ``order``. NULL keys form a group. Rows are
    shuffled once, counted inside their chunk and stored; what earlier chunks add is
    read from the stored table's few key columns.
    """
    keys = list(keys)
    here = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    stored = cut(df.withColumns({f"__here_{name}": F.count_if(test).over(here) for name, test in counts.items()}))
    return add_carried(stored, keys, chunk, {f"__here_{name}": name for name in counts})


def add_carried(stored: DataFrame, keys: Sequence[str], chunk: str, names: Mapping[str, str], keep: bool = False) -> DataFrame:
    """Turn counts that start anew in each chunk into counts over the whole group.

    ``names`` maps the column counted inside the chunk to the result's name; ``keep`` leaves that column too.
    Where no group has a second chunk, nothing is joined.
    """
    before = {local: f"__before_{name}" for local, name in names.items()}
    # A count never falls, so its last value in a chunk is its greatest.
    per_chunk = stored.groupBy(*keys, chunk).agg(*[F.max(local).alias(local) for local in names])
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(F.col(chunk).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per chunk, stored: the planner then knows its real size, and need not shuffle the rows.
    carried = cut(
        per_chunk.select(*keys, chunk, *[F.sum(local).over(earlier).alias(b) for local, b in before.items()])
        .where(reduce(lambda a, b: a | b, [F.col(b) > 0 for b in before.values()]))
        .withColumnsRenamed({k: f"__of_{k}" for k in [*keys, chunk]})
    )
    kept = [c for c in stored.columns if keep or c not in names]
    if carried.isEmpty():
        return stored.select(*kept, *[F.col(local).alias(name) for local, name in names.items()])
    same_chunk = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in [*keys, chunk]])
    return stored.join(carried, same_chunk, "left").select(
        *kept, *[(F.col(local) + F.coalesce(F.col(before[local]), F.lit(0))).alias(name) for local, name in names.items()]
    )


def looking_back(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    reach: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    block: str = "block",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``reach`` rows back.

    ``position`` numbers a group 1, 2, 3 …; blocks hold ``rows`` positions, and the
    last ``reach`` rows of a block also visit the next one, where only its own rows look
    back to them. Each function in ``columns`` gets the window ordered by position.
    The result keeps the block number in ``block``.
    """
    if reach >= rows:
        raise ValueError("a block must hold more rows than the window reaches back")
    offset = F.col(position) - 1
    own = F.floor(offset / F.lit(rows)).cast("bigint")
    visits = F.when(offset % rows >= rows - reach, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("__own", own).withColumn(block, F.explode(visits))
    ordered = Window.partitionBy(*keys, block).orderBy(position)
    looked = spread.withColumns({name: make(ordered) for name, make in columns.items()})
    return looked.where(F.col(block) == F.col("__own")).drop("__own")


def trailing_share(count: Column, count_before: Column, position: Column, rows: int) -> Column:
    """Share of counted rows among the last ``rows``, from running counts now and ``rows`` rows ago.

    Two numbers per row instead of a frame walked anew for each row.
    """
    return (count - F.coalesce(count_before, F.lit(0))) / F.least(position, F.lit(rows))


def sequence_number(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[Column], name: str) -> DataFrame:
    """ROW_NUMBER per group, in chunks."""
    return running_counts(df, keys, chunk, order, {name: F.lit(True)})


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``order`` per key, by aggregation instead of a sort.

    Partial aggregation leaves at most one row per key and task to shuffle.
    NULL order values rank lowest.
    """
    row = F.struct(*df.columns)
    kept = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("__row"))
    return kept.select("__row.*")


def greatest_per_key(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """The greatest ``measure`` per key: the first row by descending measure."""
    return df.groupBy(*keys).agg(F.max(measure).alias(measure))


def group_mean_beside(df: DataFrame, keys: Mapping[str, Column], means: Mapping[str, Column], few: bool = False) -> DataFrame:
    """Put each group's mean beside its rows.

    Means come from a partial aggregation and join back, so no group is gathered.
    ``few`` promises that the keys can only take a few values, whatever the data.
    """
    keyed = df.withColumns({f"__k_{k}": c for k, c in keys.items()})
    names = [f"__k_{k}" for k in keys]
    table = keyed.groupBy(*names).agg(*[m.alias(n) for n, m in means.items()])
    table = table.withColumnsRenamed({n: f"{n}_of" for n in names})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}_of")) for n in names])
    return keyed.join(F.broadcast(table) if few else table, same, "left").select(*df.columns, *means)
