"""Exact medians of groups of any size, by searching only the range of values that holds the middle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges the values of a measure are cut into; a task holds about one of them.
RANGES = 64


def counted_values(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """How often each value of each name occurs by keys; equal values are counted in the map tasks."""
    entries = F.array(*[F.struct(F.lit(n).alias("_name"), v.cast("double").alias("_value"))
                        for n, v in values.items()])
    return df.select(*keys, F.inline(entries)).filter("_value is not null").groupBy(
        *keys, "_name", "_value").agg(F.count(F.lit(1)).alias("_n"))


def ranged(counted: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The counted values with the number of the range of its name that each lies in.

    The bounds are about evenly spaced among the counted values, so a range holds about as many as
    any other, whatever share of all rows a group or a value has. They are literals: the number
    of a value's range does not depend on where and how often it is computed.
    """
    shares = [k / ranges for k in range(1, ranges)]
    bounds = counted.groupBy("_name").agg(
        F.percentile_approx("_value", F.array(*map(F.lit, shares)), 10 * ranges).alias("bounds"))
    number: Column = F.lit(0)
    for row in bounds.collect():  # one row for each measure
        steps = F.array(*[F.lit(float(b)) for b in sorted(set(row["bounds"] or ()))]).cast("array<double>")
        below = F.size(F.filter(steps, lambda b: b <= F.col("_value")))
        number = F.when(F.col("_name") == row["_name"], below).otherwise(number)
    return counted.withColumn("_range", number)


def exact_medians(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column],
                  ranges: int = RANGES) -> DataFrame:
    """Exact medians of several values by keys; null for a group without a value.

    Counts of the ranges, summed up in their order, show which one or two ranges of a group hold the
    middle; only the values in these are sorted. No task holds the values of a whole group.
    """
    cut = ranged(counted_values(df, keys, values), ranges)
    group = [*keys, "_name"]
    in_order = Window.partitionBy(*group).orderBy("_range")  # at most ``ranges`` rows
    sums = cut.groupBy(*group, "_range").agg(F.sum("_n").alias("_rows")).withColumns({
        "_ahead": F.sum("_rows").over(in_order) - F.col("_rows"),
        "_last": F.sum("_rows").over(Window.partitionBy(*group)) - 1,
    })
    half = F.col("_last") / 2

    def inside(place: Column, ahead: str, rows: str) -> Column:
        return (F.col(ahead) <= place) & (place < F.col(ahead) + F.col(rows))

    holds = inside(F.floor(half), "_ahead", "_rows") | inside(F.ceil(half), "_ahead", "_rows")
    middle = sums.filter(holds).select(
        *[F.col(c).alias(f"_{c}") for c in [*group, "_range"]], "_ahead", "_last")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, "_range"]])
    near = cut.join(middle, same).select(*group, "_range", "_value", "_n", "_ahead", "_last")
    sorted_ = Window.partitionBy(*group, "_range").orderBy("_value")
    near = near.withColumn("_before", F.col("_ahead") + F.sum("_n").over(sorted_) - F.col("_n"))

    def at(place: Column) -> Column:
        return F.max(F.when(inside(place, "_before", "_n"), F.col("_value")))

    found = near.groupBy(*group).agg(
        (at(F.floor(half)) * 0.5 + at(F.ceil(half)) * 0.5).alias("_median"))
    return found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_name") == n, F.col("_median"))).alias(n) for n in values])
