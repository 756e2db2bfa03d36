"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips import rules
from citytrips.functions import (
    band, by_hour, by_member, c_to_f, calendar, compass, hour_in, round_half_away, series_of_days,
)
from citytrips.operators.staging import date_bounds


def _yes(condition: Column) -> Column:
    """A flag that is false where the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def dim_date(trips: DataFrame) -> DataFrame:
    """One row per calendar day between the first and the last pickup."""
    days = date_bounds(trips).select(
        F.explode(series_of_days(F.col("min_date"), F.col("max_date"))).alias("d")
    )
    return days.select(*[c.alias(n) for n, c in calendar(F.col("d")).items()])


def time_spine(spark: SparkSession, start: str = rules.SPINE_START,
               end: str = rules.SPINE_END) -> DataFrame:
    """Consecutive days from start up to, not including, end."""
    first, after = F.lit(start).cast("date"), F.lit(end).cast("date")
    return spark.range(1).select(
        F.explode(series_of_days(first, F.date_sub(after, 1))).alias("date_day")
    )


def hour_flags(hour: Column) -> dict[str, Column]:
    """Attributes of an hour that both the hour dimension and the trip fact carry."""
    return {
        "day_part": by_hour(hour, rules.DAY_PARTS, rules.DAY_PART_REST),
        "is_rush_hour": hour_in(hour, rules.RUSH_HOURS),
        "is_business_hours": hour_in(hour, rules.BUSINESS_HOURS),
        "is_late_night": hour_in(hour, rules.LATE_NIGHT_HOURS),
    }


def dim_time(spark: SparkSession) -> DataFrame:
    """The 24 hours of a day."""
    hour = F.col("hour")
    flags = hour_flags(hour)
    return spark.range(24).select(F.col("id").cast("int").alias("hour")).select(
        hour.cast("string").alias("time_key"),
        "hour",
        ((hour + 11) % 12 + 1).alias("hour_12"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        *[flags[n].alias(n) for n in ("day_part", "is_business_hours", "is_rush_hour",
                                      "is_late_night")],
        hour_in(hour, rules.DINING_HOURS).alias("is_dining_hours"),
        by_hour(hour, rules.TIME_PERIODS, rules.TIME_PERIOD_REST).alias("time_period"),
    )


def _precipitation_type(total: Column, rain: Column, snow: Column) -> Column:
    rains, snows = rain > 0, snow > 0
    return (
        F.when(total == 0, "none")
        .when(snows, F.when(rains, "mixed").otherwise("snow"))
        .when(rains, "rain")
        .otherwise("none")
    )


def _description(temp: Column, total: Column, rain: Column, snow: Column, cloud: Column) -> Column:
    """Storms come before snow, snow before rain, rain before the cloud cover."""
    return (
        F.when(total > 10, F.when(temp < 0, "blizzard").otherwise("severe_storm"))
        .when(snow > 0, F.when(snow > 5, "heavy_snow").otherwise("snow"))
        .when(
            rain > 0,
            F.when(rain > 7.6, "heavy_rain")
            .when(rain > 2.5, "moderate_rain")
            .otherwise("light_rain"),
        )
        .otherwise(
            F.when(cloud > 75, "cloudy").when(cloud > 50, "partly_cloudy").otherwise("clear")
        )
    )


def dim_weather(stg: DataFrame) -> DataFrame:
    """Measurements of an hour with categories, other units and comfort flags."""
    temp, feels, total, rain, snow, cloud, wind = (
        F.col(c) for c in ("temp", "feels_like", "precipitation", "rain", "snowfall",
                           "cloud_cover", "wind_speed")
    )
    dry = total == 0
    return stg.select(
        F.col("timestamp").alias("weather_key"),
        "timestamp", "temp", "feels_like", "humidity", "dew_point", "precipitation", "rain",
        "snowfall", "cloud_cover", "pressure", "wind_speed", "wind_direction",
        band(temp, rules.TEMPERATURE).alias("temp_category"),
        band(feels, rules.FEELS_LIKE).alias("feels_like_category"),
        c_to_f(temp).alias("temp_fahrenheit"),
        c_to_f(feels).alias("feels_like_fahrenheit"),
        _precipitation_type(total, rain, snow).alias("precipitation_type"),
        F.when(dry, rules.INTENSITIES[0]).otherwise(band(total, rules.INTENSITY))
        .alias("precipitation_intensity"),
        _yes(total > 0).alias("has_precipitation"),
        band(wind, rules.WIND).alias("wind_category"),
        round_half_away(wind * rules.MPH_PER_MS, 1).alias("wind_speed_mph"),
        compass(F.col("wind_direction")).alias("wind_direction_cardinal"),
        band(cloud, rules.CLOUD).alias("cloud_cover_category"),
        band(F.col("humidity"), rules.HUMIDITY).alias("humidity_category"),
        _description(temp, total, rain, snow, cloud).alias("weather_description"),
        _yes(dry & temp.between(15, 25) & (wind < 10) & (cloud < 50)).alias("is_pleasant_weather"),
        (_yes(total > 5) | _yes((temp < -5) | (temp > 35)) | _yes(wind > 15))
        .alias("is_adverse_weather"),
        _yes(dry & temp.between(10, 25) & (wind < 15)).alias("is_good_cycling_weather"),
    )


def dim_location(zones: DataFrame) -> DataFrame:
    """Zones with tiers, regions and flags."""
    borough, zone, service = F.col("borough"), F.col("zone"), F.col("service_zone")
    listed = {
        "is_high_demand_zone": rules.HIGH_DEMAND_ZONES,
        "is_transportation_hub": rules.HUB_ZONES,
        "is_tourist_area": rules.TOURIST_ZONES,
        "is_business_district": rules.BUSINESS_ZONES,
    }
    return zones.select(
        F.col("location_id").cast("string").alias("location_key"),
        "location_id",
        "borough",
        zone.alias("zone_name"),
        "service_zone",
        by_member(borough, rules.LOCATION_TIERS, rules.LOCATION_TIER_REST).alias("location_tier"),
        by_member(borough, rules.BOROUGH_REGIONS, rules.BOROUGH_REGION_REST)
        .alias("borough_region"),
        _yes(service == "Yellow Zone").alias("is_yellow_zone"),
        _yes(service == "Boro Zone").alias("is_boro_zone"),
        (_yes(service == "Airports") | _yes(borough == "EWR")).alias("is_airport"),
        *[_yes(zone.isin(list(names))).alias(flag) for flag, names in listed.items()],
    )
