"""Column expressions: text, numbers, dates, choices. Everything stays in the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- text -------------------------------------------------------------------


def concat_present(*parts: Column) -> Column:
    """Concatenation that leaves NULL parts out."""
    return F.concat_ws("", *[p.cast("string") for p in parts])


def concat_strict(left: Column, separator: str, right: Column) -> Column:
    """Concatenation that is NULL as soon as one part is."""
    return F.concat(left, F.lit(separator), right)


def without_text(text: Column, piece: str) -> Column:
    """``text`` with every occurrence of a fixed piece removed."""
    return F.replace(text, F.lit(piece), F.lit(""))


def grouped_digits_to_long(text: Column) -> Column:
    """'1,234,567' as a number; anything else that is not a number raises."""
    return without_text(text, ",").cast("bigint")


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE against at least one pattern."""
    return reduce(lambda a, b: a | b, [text.ilike(p) for p in patterns])


# --- numbers ----------------------------------------------------------------


def round_to(value: Column, digits: int) -> Column:
    """Round a double half away from zero on the scaled value.

    ``F.round`` works on the printed decimal and differs on binary ties.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale)) / F.lit(scale)


def fahrenheit(celsius: Column) -> Column:
    return round_to(celsius * F.lit(9.0 / 5.0) + F.lit(32.0), 2)


def per_100k(count: Column, population: Column) -> Column:
    """Events per 100,000 inhabitants, three digits; NULL without inhabitants."""
    hundred_thousands = population.cast("double") / F.lit(100000.0)
    return round_to(F.try_divide(count.cast("double"), hundred_thousands), 3)


def absent_nan(value: Column) -> Column:
    """NaN as NULL."""
    return F.when(~F.isnan(value), value)


# --- dates ------------------------------------------------------------------


def hours_earlier(instant: Column, hours: int) -> Column:
    """A fixed offset, the same all year."""
    return instant - F.make_dt_interval(hours=F.lit(hours))


def iso_instant(text: Column) -> Column:
    """UTC text such as 2025-01-31T12:00:00.000Z as a zone-free timestamp."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def point(value: object) -> Column:
    """A literal day or instant; instants carry no zone, whatever the session's is."""
    if isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def in_range(column: Column, start: object, end: object) -> Column:
    """Half-open interval test."""
    return (column >= point(start)) & (column < point(end))


# --- choices ----------------------------------------------------------------


def flag(condition: Column) -> Column:
    """A condition as a two-valued boolean: unknown counts as false."""
    return F.when(condition, F.lit(True)).otherwise(F.lit(False))


def outcome_label(is_tie: Column, away_score: Column, home_score: Column, won: Column) -> Column:
    """win / loss / tie; NULL for level scores that are not declared a tie.

    The order of the tests matters: an unknown ``won`` falls through to a loss.
    """
    return (
        F.when(is_tie, F.lit("tie"))
        .when((away_score == home_score) & ~is_tie, F.lit(None).cast("string"))
        .when(won, F.lit("win"))
        .otherwise(F.lit("loss"))
    )


def outcome_value(outcome: Column) -> Column:
    """1 for a win, 0 for a loss, NULL for everything else."""
    return F.when(outcome == "win", F.lit(1)).when(outcome == "loss", F.lit(0))


def by_side(is_home: Column, home: Column, away: Column) -> Column:
    return F.when(is_home, home).otherwise(away)


def pick_source(
    primary: Column,
    fallback: Column,
    is_complete: Column,
    labels: Mapping[str, str],
) -> tuple[Column, Column]:
    """Reconcile two sources of one figure; returns the value and where it came from.

    The primary source is preferred while its day is complete, the fallback otherwise.
    ``labels`` names primary, fallback, incomplete and missing.
    """
    value = F.when(is_complete, F.coalesce(primary, fallback)).otherwise(F.coalesce(fallback, primary))
    origin = (
        F.when(is_complete & primary.isNotNull(), F.lit(labels["primary"]))
        .when(fallback.isNotNull(), F.lit(labels["fallback"]))
        .when(primary.isNotNull(), F.lit(labels["incomplete"]))
        .otherwise(F.lit(labels["missing"]))
    )
    return value, origin


def category_counts(text: Column, categories: Mapping[str, Sequence[str]]) -> list[Column]:
    """One count per category; a row counts once in each category it matches."""
    return [
        F.sum(F.when(matches_any(text, patterns), F.lit(1)).otherwise(F.lit(0))).alias(name)
        for name, patterns in categories.items()
    ]
