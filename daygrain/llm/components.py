"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.session import cut


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every id in ``links`` (a, b): the smallest id that can be reached.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to the
    larger ones, then to the smaller ones, so that trees flatten into stars in about log n rounds.
    A node's neighbours are never gathered: both steps are a minimum for each node, combined
    before the shuffle, and a join that adaptive execution can split.
    """
    edges = cut(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Below, v is the smaller end: each node keeps its smallest neighbour and links the others to it.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = cut(small.where("u <> v").distinct())
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            break
        state = now
    # Every remaining link points at the smallest id of its star.
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )
