"""Daily incident counts by category and their rates per 100,000 inhabitants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.columns import category_counts, per_100k
from daygrain.operators.joins import with_default_row

# Categories of the incident table and the patterns that select them.
CATEGORIES: dict[str, list[str]] = {
    "violent_crime": ["%homicide%", "%assault%", "%rape%", "%robber%"],
    "homicide": ["%homicide%"],
    "assault": ["%assault%"],
    "rape": ["%rape%"],
    "robbery": ["%robber%"],
    "theft": ["%theft%"],
    "burglary": ["%burglar%"],
    "arson": ["%arson%"],
}


def daily_counts(incidents: DataFrame, categories: Mapping[str, Sequence[str]] = CATEGORIES) -> DataFrame:
    """Counts per day; partial aggregation shuffles at most one row per day and task."""
    return incidents.groupBy("dispatch_date", "dispatch_year").agg(
        F.count("incident_type").alias("total_incidents"),
        *category_counts(F.col("incident_type"), categories),
    )


def daily_rates(
    incidents: DataFrame,
    population: DataFrame,
    area: str,
    categories: Mapping[str, Sequence[str]] = CATEGORIES,
) -> DataFrame:
    """Counts and rates; a year without its own estimate uses the latest year's."""
    counts = ["total_incidents", *categories]
    estimates = population.where(F.col("geographic_area").ilike(area)).select("year", "population")
    of_year = estimates.select(F.col("year").alias("__year"), F.col("population").alias("__of_year"))
    days = daily_counts(incidents, categories).join(of_year, F.col("dispatch_year") == F.col("__year"), "left")
    latest = estimates.select("year", F.col("population").alias("__latest"))
    days = with_default_row(days, latest, [F.col("year").desc_nulls_last(), F.col("__latest").desc_nulls_last()])
    # Estimates of equal size for one year fall into one row, as they share the group.
    days = days.groupBy("dispatch_date", "dispatch_year", "__of_year", "__latest").agg(*[F.sum(c).alias(c) for c in counts])
    days = days.withColumn("population", F.coalesce("__of_year", "__latest"))
    columns = []
    for name in counts:
        columns += [F.col(name), per_100k(F.col(name), F.col("population")).alias(f"{name}_per_100k")]
    return days.select("dispatch_date", "population", *columns)
