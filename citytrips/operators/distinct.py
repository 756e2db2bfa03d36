"""Exact numbers of different days and hours that can be added up again.

A state is the set of days or hours of some trips, as bitmaps of 32,768 bits. States of months and
modes are kept; any coarser question, and any range of days, is answered from them without the
trips, where counts could not be added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITMAP = 32_768
KINDS = ("day", "hour")


def _numbers(day: Column, hour: Column) -> Column:
    """Days and hours since 1970, one row each."""
    days = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")
    pairs = [F.struct(F.lit("day").alias("kind"), days.alias("number")),
             F.struct(F.lit("hour").alias("kind"), (days * 24 + hour).alias("number"))]
    return F.inline(F.array(*pairs))


def _bitmaps(numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    return numbered.filter("number is not null").groupBy(
        *keys, "kind", F.floor(F.col("number") / BITMAP).alias("part")).agg(
        F.bitmap_construct_agg(F.pmod("number", F.lit(BITMAP).cast("long"))).alias("bits"))


def distinct_states(trips: DataFrame, keys: Sequence[str] = ("pickup_month", "trip_type"),
                    ts: str = "pickup_datetime") -> DataFrame:
    """keys, kind, part, bits: the days and hours with trips. A few bitmaps a task are shuffled."""
    return _bitmaps(trips.select(*keys, _numbers(F.to_date(ts), F.hour(ts))), keys)


def merge_states(states: DataFrame, more: DataFrame) -> DataFrame:
    """States of both; merging the same trips again changes nothing."""
    keys = [c for c in states.columns if c != "bits"]
    return states.unionByName(more).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))


def range_states(spark: SparkSession, first: str, last: str) -> DataFrame:
    """The state of all days and hours from one date to another, a calendar."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    hours = days.select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    return _bitmaps(hours.select(_numbers(F.col("day"), F.col("h"))), ())


def distinct_counts(states: DataFrame, by: Sequence[str] = (), first: str | None = None,
                    last: str | None = None) -> DataFrame:
    """by, n_days, n_hours: different days and hours of the groups, of all days or of a range."""
    sets = states.groupBy(*by, "kind", "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    if first is not None or last is not None:
        inside = range_states(states.sparkSession, first or "0001-01-01", last or "9999-12-31")
        both = sets.join(inside.withColumnRenamed("bits", "_inside"), ["kind", "part"])
        both = both.withColumn("bits", F.explode(F.array("bits", "_inside")))
        sets = both.groupBy(*by, "kind", "part").agg(F.bitmap_and_agg("bits").alias("bits"))
        sets = sets.filter(F.bitmap_count("bits") > 0)  # a group without trips in the range has no row
    size = F.bitmap_count("bits")
    sums = {f"n_{kind}s": F.coalesce(F.sum(F.when(F.col("kind") == kind, size)), F.lit(0)) for kind in KINDS}
    return sets.groupBy(*by).agg(*[s.cast("long").alias(n) for n, s in sums.items()])
