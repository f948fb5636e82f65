"""Joins that need more than a keyword."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.session import once


def full_outer_split(many: DataFrame, one: DataFrame, many_key: str, one_key: str) -> DataFrame:
    """Full outer join for a side that may hold very many rows per key.

    A full outer join cannot split a hot key. A left join can, and the rows of
    ``one`` without a partner are few and come from an anti join. Both halves read both sides, so these are stored.
    """
    many, one = once(many), once(one)
    matched = many.join(one, F.col(many_key) == F.col(one_key), "left")
    partners = many.select(F.col(many_key).alias("__partner")).distinct()
    alone = one.join(partners, F.col(one_key) == F.col("__partner"), "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in many.schema.fields]
    return matched.unionByName(alone.select(*missing, *one.columns))


def explode_either(df: DataFrame, left_key: Column, right_key: Column, key: str, is_left: str) -> DataFrame:
    """One row per distinct key of two, so that ``k = a OR k = b`` becomes an equi join."""
    sides = F.array(
        F.struct(left_key.alias(key), F.lit(True).alias(is_left)),
        F.struct(right_key.alias(key), F.lit(False).alias(is_left)),
    )
    once = F.filter(sides, lambda s: s[is_left] | ~s[key].eqNullSafe(left_key))
    return df.select("*", F.inline(once))


def with_default_row(df: DataFrame, default: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Attach the first row of ``default`` to every row; its columns are NULL when there is none.

    A scalar subquery: top one per task, then one row, and no join at all.
    """
    first = default.orderBy(*order).limit(1).select(F.struct(*default.columns))
    attached = df.withColumn("__default", first.scalar())
    return attached.select(*df.columns, *[F.col(f"__default.{c}").alias(c) for c in default.columns])
