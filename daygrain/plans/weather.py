"""Daily weather from two sources, each figure with its provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.functions.columns import pick_source, round_to

# Provenance labels of the weather table.
LABELS = {"primary": "METAR", "fallback": "NCEI", "incomplete": "METAR - INCOMPLETE", "missing": "NA"}

FIGURES = ("avg_temp_deg_f", "max_temp_deg_f", "min_temp_deg_f", "total_precip_inches")


def observed_days(observations: DataFrame, clock: str = "report_time_est") -> DataFrame:
    """Observations by local day; a day without precipitation reports has none, not NULL."""
    return observations.groupBy(F.to_date(clock).alias("report_date")).agg(
        F.max("temp_deg_f").alias("max_temp_deg_f"),
        round_to(F.avg("temp_deg_f"), 2).alias("avg_temp_deg_f"),
        F.min("temp_deg_f").alias("min_temp_deg_f"),
        F.coalesce(round_to(F.sum("precip_last_6hrs_inches"), 3), F.lit(0.0)).alias("total_precip_inches"),
        F.count(clock).alias("daily_count"),
    )


def official_days(station_days: DataFrame) -> DataFrame:
    """Station figures as decimals."""
    return station_days.select(
        F.col("report_date").cast("date").alias("report_date"),
        *[F.col(c).cast("decimal(5,2)").alias(c) for c in FIGURES[:3]],
        F.col(FIGURES[3]).cast("decimal(5,3)").alias(FIGURES[3]),
    )


def daily_weather(observations: DataFrame, station_days: DataFrame, complete_above: int = 15, clock: str = "report_time_est") -> DataFrame:
    """Observed and official days side by side; observed figures win on days with enough reports."""
    observed = observed_days(observations, clock).withColumnsRenamed({c: f"obs_{c}" for c in FIGURES})
    official = official_days(station_days).withColumnsRenamed({c: f"off_{c}" for c in FIGURES})
    days = observed.join(official, "report_date", "full")
    columns = []
    for figure in FIGURES:
        value, origin = pick_source(
            F.col(f"obs_{figure}"),
            F.col(f"off_{figure}").cast("double"),
            F.col("daily_count") > complete_above,
            LABELS,
        )
        columns += [value.alias(figure), origin.alias(f"{figure}_source")]
    return days.select("report_date", *columns)
