"""Declared rules of every table."""

from __future__ import annotations

from citytrips import rules as fixed
from citytrips.plans.quality import (
    Rule, accepted, between, flags, holds, not_null, relationship, row_count, unique,
)

# Staged tables, whose rules can be checked while they are written.
STAGED = ("stg_yellow", "stg_fhv", "stg_bike", "stg_weather")

# Tests that run with every build of the models, by table.
DECLARED: dict[str, list[Rule]] = {
    "stg_yellow": [
        *not_null("trip_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id"),
        between("passenger_count", 0, 10),
        between("trip_distance", 0, 1000),
    ],
    "stg_fhv": not_null("trip_id", "pickup_datetime", "dropoff_datetime", "dispatching_base_num"),
    "stg_bike": [
        *unique("trip_id"),
        *not_null("trip_id", "rideable_type", "pickup_datetime", "dropoff_datetime"),
        accepted("rideable_type", fixed.RIDEABLE_TYPES),
        accepted("member_casual", fixed.RIDER_TYPES),
    ],
    "stg_weather": [
        *unique("timestamp"),
        *not_null("timestamp", "temp", "feels_like", "humidity", "precipitation", "rain",
                  "snowfall", "cloud_cover", "wind_speed", "wind_direction"),
    ],
    "dim_date": [
        *unique("date_key"),
        *not_null("date_key", "date", "is_weekend", "is_weekday", "day_of_week"),
        *flags("is_weekend", "is_weekday"),
    ],
    "dim_time": [
        *unique("time_key"),
        *not_null("time_key", "hour", "day_part", "is_rush_hour", "is_business_hours"),
        accepted("hour", range(24)),
        accepted("day_part", fixed.DAY_PART_NAMES),
        *flags("is_rush_hour", "is_business_hours"),
    ],
    "dim_weather": [
        *unique("weather_key"),
        *not_null("weather_key", "timestamp", "temp", "temp_category", "precipitation_type",
                  "precipitation_intensity", "wind_category", "cloud_cover_category",
                  "weather_description", "is_pleasant_weather", "is_adverse_weather"),
        accepted("temp_category", fixed.TEMPERATURE.labels),
        accepted("precipitation_type", fixed.PRECIPITATION_TYPES),
        accepted("precipitation_intensity", fixed.INTENSITIES),
        accepted("wind_category", fixed.WIND.labels),
        accepted("cloud_cover_category", fixed.CLOUD.labels),
        *flags("is_pleasant_weather", "is_adverse_weather"),
    ],
    "dim_location": [
        *unique("location_key", "location_id"),
        *not_null("location_key", "location_id", "borough", "zone_name", "service_zone",
                  "location_tier", "is_yellow_zone", "is_high_demand_zone",
                  "is_transportation_hub"),
        accepted("location_tier", (*fixed.LOCATION_TIERS, fixed.LOCATION_TIER_REST)),
        *flags("is_yellow_zone", "is_high_demand_zone", "is_transportation_hub"),
    ],
    "fct_trips": [
        *unique("trip_key"),
        *not_null("trip_key", "trip_id", "trip_type", "pickup_datetime", "dropoff_datetime",
                  "date_key", "time_key", "trip_duration_minutes", "day_part", "is_weekend",
                  "is_rush_hour"),
        accepted("trip_type", fixed.MODES),
        accepted("day_part", fixed.DAY_PART_NAMES),
        *flags("is_weekend", "is_rush_hour"),
        accepted("temp_category", fixed.TEMPERATURE.labels),
        accepted("precipitation_type", fixed.PRECIPITATION_TYPES),
        relationship("date_key", "dim_date"),
        relationship("time_key", "dim_time"),
    ],
    "fct_hourly_mobility": [
        *not_null("hour_timestamp", "date_key", "time_key", "trip_count", "trip_type"),
        accepted("trip_type", fixed.MODES),
        relationship("date_key", "dim_date"),
        relationship("time_key", "dim_time"),
    ],
}

# Expectation suites: counts, keys, completeness, ranges and categories of a table.
EXPECTATIONS: dict[str, list[Rule]] = {
    "stg_yellow": [
        row_count(1000), *unique("trip_id"),
        *not_null("trip_id", "pickup_datetime", "dropoff_datetime"),
        between("trip_distance", 0, mostly=0.99), between("total_amount", -10, 5000, mostly=0.99),
    ],
    "stg_fhv": [row_count(1000), *unique("trip_id"), *not_null("trip_id", "pickup_datetime")],
    "stg_bike": [
        row_count(1000), *unique("trip_id"), *not_null("trip_id", "pickup_datetime"),
        accepted("member_casual", fixed.RIDER_TYPES),
    ],
    "stg_weather": [
        row_count(24), *unique("timestamp"), *not_null("timestamp"),
        between("temp", -50, 60), between("humidity", 0, 100),
    ],
    "dim_date": [
        row_count(1), *unique("date_key"), *not_null("date_key"),
        between("month", 1, 12), between("day_of_week", 0, 6),
    ],
    "dim_time": [
        row_count(24, 24), *unique("time_key"), *not_null("time_key"), between("hour", 0, 23),
        accepted("day_part", fixed.DAY_PART_NAMES),
    ],
    "dim_weather": [
        row_count(24), *unique("weather_key"), *not_null("weather_key"),
        accepted("temp_category", fixed.TEMPERATURE.labels),
        accepted("precipitation_type", fixed.PRECIPITATION_TYPES),
    ],
    "dim_location": [
        row_count(260, 270), *unique("location_key"), *not_null("location_key", "borough"),
        between("location_id", 1, 265),
    ],
    "fct_trips": [
        row_count(1000), *unique("trip_key"),
        *not_null("trip_key", "trip_type", "pickup_datetime"),
        accepted("trip_type", fixed.MODES), accepted("day_part", fixed.DAY_PART_NAMES),
        between("trip_duration_minutes", 0, 1440, mostly=0.99),
        holds("weather_coverage", "temp_category is not null", mostly=0.9999),
    ],
    "fct_hourly_mobility": [
        row_count(24), *not_null("hour_timestamp", "trip_type", "trip_count"),
        between("trip_count", 1), accepted("trip_type", fixed.MODES),
    ],
}

# Soft rules of the business, on staged trips and weather.
BUSINESS: dict[str, list[Rule]] = {
    "stg_yellow": [
        holds("end_after_start", "dropoff_datetime >= pickup_datetime"),
        holds("zone_ids", "pickup_location_id between 1 and 265"
              " and dropoff_location_id between 1 and 265"),
        *[between(c, 0) for c in ("fare_amount", "total_amount", "trip_distance",
                                  "passenger_count")],
    ],
    "stg_fhv": [
        holds("end_after_start", "dropoff_datetime >= pickup_datetime"),
        holds("zone_ids", "pickup_location_id between 1 and 265"
              " and dropoff_location_id between 1 and 265"),
    ],
    "stg_bike": [
        holds("end_after_start", "dropoff_datetime >= pickup_datetime"),
        *[between(c, 40.61, 40.89) for c in ("start_lat", "end_lat")],
        *[between(c, -74.04, -73.85) for c in ("start_lng", "end_lng")],
    ],
    "stg_weather": [
        holds("precipitation_is_sum", "abs(precipitation - (rain + snowfall)) < 0.001"),
    ],
}
