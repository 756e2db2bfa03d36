"""Expressions that turn values into labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from citytrips import rules
from citytrips.rules import Bands


def band(x: Column, bands: Bands) -> Column:
    """Label of the half-open band holding x; nulls get the last label."""
    result = None
    for edge, label in zip(bands.edges, bands.labels):
        result = (F if result is None else result).when(x < edge, label)
    return result.otherwise(bands.labels[-1])


def hour_in(hour: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """Whether the hour lies in any of the inclusive ranges; false for a null hour."""
    hours = [h for low, high in ranges for h in range(low, high + 1)]
    return F.coalesce(hour.isin(hours), F.lit(False))


def by_hour(hour: Column, names: Mapping[str, tuple[int, int]], rest: str) -> Column:
    result = None
    for name, (low, high) in names.items():
        result = (F if result is None else result).when(hour.between(low, high), name)
    return result.otherwise(rest)


def by_member(x: Column, groups: Mapping[str, Sequence[str]], rest: str) -> Column:
    """Name of the group that lists x."""
    result = None
    for name, members in groups.items():
        result = (F if result is None else result).when(x.isin(list(members)), name)
    return result.otherwise(rest)


def compass(degrees: Column) -> Column:
    """One of eight points, each 45 degrees wide and centred; north wraps around.

    Whatever lies below 22.5 or from 337.5 up is north, as there is no upper bound.
    """
    sector = F.floor((degrees + 22.5) / 45).cast("int")
    point = F.element_at(
        F.array(*[F.lit(p) for p in rules.COMPASS]),
        F.when((sector < 1) | (sector > 7), 1).otherwise(sector + 1),
    )
    return F.when(degrees.isNull(), rules.COMPASS_UNKNOWN).otherwise(point)


def title_label(x: Column) -> Column:
    """``yellow_taxi`` → ``Yellow Taxi``."""
    return F.initcap(F.replace(x, F.lit("_"), F.lit(" ")))


def human_number(x: Column) -> Column:
    """1234567 → 1.23M, 1234 → 1.2K."""
    value = x.cast("double")
    return (
        F.when(value >= 1e6, F.format_string("%.2fM", value / 1e6))
        .when(value >= 1e3, F.format_string("%.1fK", value / 1e3))
        .otherwise(F.format_string("%.0f", value))
    )


def none_text(x: Column, missing: str = "N/A") -> Column:
    """Text of a value, with a word for null."""
    return F.coalesce(x.cast("string"), F.lit(missing))
