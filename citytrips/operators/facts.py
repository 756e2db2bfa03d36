"""Fact builders: trips enriched with weather, and the hourly aggregate."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citytrips import rules
from citytrips.functions import (
    day_of_week, floor_hour, iso_date, minute_diff, month_key, percent, speed_mph, surrogate_key,
)
from citytrips.operators.dims import hour_flags
from citytrips.operators.selection import counted_values

# Weather columns a trip carries: name on the fact → name in the weather dimension.
TRIP_WEATHER = {
    "temperature_celsius": "temp",
    "temperature_fahrenheit": "temp_fahrenheit",
    **{
        name: name
        for name in (
            "feels_like", "feels_like_fahrenheit", "humidity", "precipitation", "rain",
            "snowfall", "wind_speed", "wind_speed_mph", "temp_category", "feels_like_category",
            "precipitation_type", "precipitation_intensity", "wind_category",
            "wind_direction_cardinal", "cloud_cover_category", "humidity_category",
            "weather_description", "is_pleasant_weather", "is_adverse_weather",
            "is_good_cycling_weather",
        )
    },
}

TRIP_COLUMNS = (
    "trip_key", "date_key", "time_key", "pickup_location_key", "dropoff_location_key",
    "trip_id", "trip_type", "payment_type", "member_type", "rideable_type",
    "pickup_datetime", "dropoff_datetime",
    "trip_duration_minutes", "trip_distance", "avg_speed_mph", "passenger_count", "revenue",
    "pickup_hour", "day_of_week", "is_weekend", "day_part", "is_rush_hour",
    "is_business_hours", "is_late_night",
    *TRIP_WEATHER,
)


def with_time_flags(trips: DataFrame) -> DataFrame:
    """Add duration, speed and the calendar flags of the pickup."""
    pickup = F.col("pickup_datetime")
    timed = trips.withColumns({
        "trip_duration_minutes": minute_diff(pickup, F.col("dropoff_datetime")),
        "pickup_hour": F.hour(pickup),
        "day_of_week": day_of_week(pickup),
    })
    return timed.withColumns({
        "avg_speed_mph": speed_mph(F.col("trip_distance"), F.col("trip_duration_minutes")),
        "is_weekend": F.coalesce(F.col("day_of_week").isin(0, 6), F.lit(False)),
        **hour_flags(F.col("pickup_hour")),
    })


def with_keys(trips: DataFrame) -> DataFrame:
    """Add the surrogate key and the text keys of the dimensions."""
    return trips.withColumns({
        "trip_key": surrogate_key("trip_id"),
        "date_key": iso_date(F.col("pickup_datetime")),
        "time_key": F.hour("pickup_datetime").cast("string"),
        "pickup_location_key": F.col("pickup_location_id").cast("string"),
        "dropoff_location_key": F.col("dropoff_location_id").cast("string"),
    })


def join_weather(trips: DataFrame, weather: DataFrame, ts: str = "pickup_datetime",
                 how: str = "left") -> DataFrame:
    """Equi-join trips to the weather of their hour.

    No broadcast is forced. A weather table read from Parquet has a known size, and Spark
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined
    by sort-merge, where adaptive execution splits hours that hold very many trips.
    """
    left = trips.withColumn("_hour", floor_hour(F.col(ts)))
    right = weather.withColumn("_hour", floor_hour(F.col("timestamp")))
    return left.join(right, "_hour", how).drop("_hour")


def fct_trips(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Trip fact, plus ``pickup_month`` (yyyymm) as its partition column, which trips may carry."""
    attributes = weather.select(
        "timestamp", *[F.col(old).alias(new) for new, old in TRIP_WEATHER.items()]
    )
    enriched = join_weather(with_keys(with_time_flags(trips)), attributes)
    # kept where it is known, so that the order of trips by month is known as well
    month = F.col("pickup_month") if "pickup_month" in trips.columns else month_key(F.col("pickup_datetime"))
    return enriched.select(*TRIP_COLUMNS, month.alias("pickup_month"))


def with_weather(fct: DataFrame, weather: DataFrame, changed: DataFrame, few: bool) -> DataFrame:
    """The trip fact with the attributes of the given weather in the ``hour`` values of changed.

    Other trips keep theirs; a changed hour the weather lacks has none. ``few`` hours are
    broadcast, so that the trips stay where they are.
    """
    attributes = weather.select(floor_hour(F.col("timestamp")).alias("_hour"), *[
        F.col(old).alias(f"_{new}") for new, old in TRIP_WEATHER.items()])
    hours = changed.select(F.col("hour").alias("_hour")).distinct()
    present = hours.join(attributes, "_hour", "left").withColumn("_changed", F.lit(True))
    joined = fct.withColumn("_hour", floor_hour(F.col("pickup_datetime"))).join(
        F.broadcast(present) if few else present, "_hour", "left")
    return joined.select(*[
        F.when(F.col("_changed"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
        if c in TRIP_WEATHER else c for c in fct.columns])


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _any(flag: str) -> Column:
    return F.max(F.coalesce(F.col(flag), F.lit(False)).cast("int"))


HOUR_GROUP = ("date_key", "time_key", "trip_type", "temp_category", "precipitation_type",
              "is_weekend", "day_part", "hour_timestamp")
HOUR_MEDIANS = {"median_trip_duration_minutes": "trip_duration_minutes",
                "median_trip_distance_miles": "trip_distance"}


def _by_hour(fct: DataFrame) -> DataFrame:
    return fct.withColumn("hour_timestamp", floor_hour(F.col("pickup_datetime")))


def _hourly_sums(fct: DataFrame) -> DataFrame:
    mode = F.col("trip_type")
    counts = {
        rules.YELLOW: "yellow_taxi_count", rules.FHV: "fhv_count", rules.BIKE: "citibike_count",
    }
    return _by_hour(fct).groupBy(*HOUR_GROUP).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration_minutes"),
        F.avg("trip_distance").alias("avg_trip_distance_miles"),
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
        F.sum("passenger_count").alias("total_passengers"),
        F.avg("temperature_celsius").alias("avg_temperature_celsius"),
        F.avg("temperature_fahrenheit").alias("avg_temperature_fahrenheit"),
        F.avg("precipitation").alias("avg_precipitation_mm"),
        F.avg("wind_speed_mph").alias("avg_wind_speed_mph"),
        F.avg("humidity").alias("avg_humidity_pct"),
        *[_count_if(mode == m).alias(name) for m, name in counts.items()],
        F.sum(F.when(mode == rules.YELLOW, F.col("revenue")).otherwise(0.0))
        .alias("yellow_taxi_revenue"),
        F.avg(F.when(mode == rules.YELLOW, F.col("revenue"))).alias("avg_yellow_taxi_fare"),
        _count_if(F.col("is_rush_hour")).alias("rush_hour_trip_count"),
        _any("is_adverse_weather").alias("has_adverse_weather"),
        _any("is_pleasant_weather").alias("has_pleasant_weather"),
        _any("is_good_cycling_weather").alias("has_good_cycling_weather"),
    )


def _hourly_medians(fct: DataFrame) -> DataFrame:
    """Exact medians of the groups that have a value, their keys as ``_<key>``."""
    counted = counted_values(_by_hour(fct), HOUR_GROUP, {n: F.col(c) for n, c in HOUR_MEDIANS.items()})
    return counted.groupBy(*[F.col(k).alias(f"_{k}") for k in HOUR_GROUP]).agg(*[
        F.percentile(F.when(F.col("_name") == n, F.col("_value")), 0.5, F.col("_n")).alias(n)
        for n in HOUR_MEDIANS])


def fct_hourly(fct: DataFrame) -> DataFrame:
    """Hourly mobility fact.

    Grain: hour × mode × weather categories. Every aggregate is combined in the map tasks
    first, the exact medians as value counts, so hours or modes holding a large share of
    all trips do not meet in one task row by row. The medians have a pass of their own: an aggregate
    with ``percentile`` holds 128 groups and then sorts whole trips, while sums and counts of
    values need no sort. So give it a written fact.
    """
    hourly = _hourly_sums(fct)
    medians = _hourly_medians(fct)
    same = reduce(and_, [hourly[k].eqNullSafe(medians[f"_{k}"]) for k in HOUR_GROUP])
    hourly = hourly.join(medians, same, "left")
    trips = F.col("trip_count")
    return hourly.withColumns({
        "hour_key": surrogate_key(
            "hour_timestamp", "trip_type", "temp_category", "precipitation_type",
            "is_weekend", "day_part",
        ),
        "citibike_mode_share_pct": percent(F.col("citibike_count"), trips),
        "yellow_taxi_mode_share_pct": percent(F.col("yellow_taxi_count"), trips),
        "fhv_mode_share_pct": percent(F.col("fhv_count"), trips),
        "rush_hour_pct": percent(F.col("rush_hour_trip_count"), trips),
    }).select(*HOURLY_COLUMNS, month_key(F.col("hour_timestamp")).alias("pickup_month"))


HOURLY_COLUMNS = (
    "hour_key", "date_key", "time_key", "trip_type", "temp_category", "precipitation_type",
    "is_weekend", "day_part", "hour_timestamp",
    "trip_count", "total_revenue", "avg_trip_duration_minutes", "avg_trip_distance_miles",
    "avg_speed_mph", "total_passengers",
    "median_trip_duration_minutes", "median_trip_distance_miles",
    "avg_temperature_celsius", "avg_temperature_fahrenheit", "avg_precipitation_mm",
    "avg_wind_speed_mph", "avg_humidity_pct",
    "yellow_taxi_count", "fhv_count", "citibike_count",
    "yellow_taxi_revenue", "avg_yellow_taxi_fare",
    "citibike_mode_share_pct", "yellow_taxi_mode_share_pct", "fhv_mode_share_pct",
    "rush_hour_trip_count", "rush_hour_pct",
    "has_adverse_weather", "has_pleasant_weather", "has_good_cycling_weather",
)
