"""What changed between two snapshots of a table, and a history made of such changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.operators.asof import same_keys
from daygrain.session import cut


def row_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that occur more often in one snapshot than in the other, and how much more often they do in ``new``.

    Columns of the rows, and ``n``: positive for rows added, negative for rows removed. NULL equals
    NULL. Equal rows of a task are counted before they are shuffled, so repeated rows are no hot group.
    """
    if old.columns != new.columns:
        raise ValueError(f"snapshots of different columns: {old.columns}, {new.columns}")
    counted = [df.groupBy(*df.columns).agg(F.sum(F.lit(sign)).alias("__n")) for df, sign in ((old, -1), (new, 1))]
    both = counted[0].unionByName(counted[1])
    return both.groupBy(*old.columns).agg(F.sum("__n").cast("bigint").alias("n")).where("n <> 0")


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key and occurrence that changed: keys, kind, n, before, after, changed.

    ``kind`` is added, removed or changed; ``before`` and ``after`` hold the other columns as structs;
    ``changed`` names those that differ. A key that loses one row and gains one has changed; any other
    key whose rows differ has rows removed and rows added, each ``n`` times. NULL keys equal each other.
    """
    rest = [c for c in old.columns if c not in keys]
    found = cut(row_difference(old, new).select(*keys, F.struct(*rest).alias("__row"), "n"))
    moves = found.groupBy(*keys).agg(
        F.sum(F.when(F.col("n") < 0, -F.col("n")).otherwise(0)).alias("__gone"),
        F.sum(F.when(F.col("n") > 0, F.col("n")).otherwise(0)).alias("__come"),
        F.max(F.when(F.col("n") < 0, F.col("__row"))).alias("before"),
        F.max(F.when(F.col("n") > 0, F.col("__row"))).alias("after"),
    )
    single = cut(moves.where("__gone = 1 AND __come = 1").drop("__gone", "__come"))
    differ = F.filter(F.array(*[F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in rest]), lambda c: c.isNotNull())
    changed = single.select(*keys, F.lit("changed").alias("kind"), F.lit(1).cast("bigint").alias("n"), "before", "after", differ.alias("changed"))
    one_each = single.select(*[F.col(k).alias(f"__of_{k}") for k in keys])
    others = found.join(one_each, same_keys(keys, one_each.columns), "left_anti")
    none = F.lit(None).cast(found.schema["__row"].dataType)
    come = F.col("n") > 0
    plain = others.select(
        *keys,
        F.when(come, "added").otherwise("removed").alias("kind"),
        F.abs("n").alias("n"),
        F.when(~come, F.col("__row")).otherwise(none).alias("before"),
        F.when(come, F.col("__row")).otherwise(none).alias("after"),
        F.lit(None).cast("array<string>").alias("changed"),
    )
    return changed.unionByName(plain)


def open_history(first: DataFrame, since: Column) -> DataFrame:
    """A history that begins with a snapshot: its distinct rows, how often each occurs (``n``), valid from ``since`` on."""
    counted = first.groupBy(*first.columns).agg(F.count("*").alias("n"))
    return counted.select("*", since.alias("valid_from"), F.lit(None).cast(first.select(since).schema[0].dataType).alias("valid_to"))


def with_difference(history: DataFrame, found: DataFrame, at: Column) -> DataFrame:
    """The history after a ``row_difference`` to the snapshot taken ``at``.

    The current entry (without valid_to) of a row whose number changed ends there, and one with its
    new number begins, unless the row is gone. Other entries stay as they are.
    """
    row = [c for c in history.columns if c not in ("n", "valid_from", "valid_to")]
    moved = found.select(*[F.col(c).alias(f"__of_{c}") for c in row], F.col("n").alias("__more"))
    same = same_keys(row, [f"__of_{c}" for c in row]) & F.col("valid_to").isNull()
    stored = cut(history.join(moved, same, "left").select(*history.columns, "__more"))
    ended = F.when(F.col("__more").isNotNull(), at).otherwise(F.col("valid_to")).alias("valid_to")
    known = stored.where("__more IS NOT NULL").select(*row, (F.col("n") + F.col("__more")).alias("n"))
    held = stored.where("__more IS NOT NULL").select(*[F.col(c).alias(f"__of_{c}") for c in row])
    unknown = found.join(held, same_keys(row, held.columns), "left_anti").select(*row, "n")
    begun = known.unionByName(unknown).where("n > 0")
    times = at.cast(history.schema["valid_from"].dataType).alias("valid_from"), F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to")
    return stored.select(*row, "n", "valid_from", ended).unionByName(begun.select("*", *times))


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The snapshot that was valid at a time: its distinct rows and how often each occurred."""
    valid = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    return history.where(valid).drop("valid_from", "valid_to")
