"""The models and their metrics."""

from __future__ import annotations

from pyspark.sql import Column

from citytrips import rules
from citytrips.functions import divide
from citytrips.plans.semantic import (
    Derived, Dimension, Entity, Measure, Metric, Ratio, SemanticModel, Simple,
)


def _share(part: Column, total: Column) -> Column:
    return divide(part, total)


def _share_pct(part: Column, total: Column) -> Column:
    return divide(part, total) * 100


def _against_rest(part: Column, total: Column) -> Column:
    return divide(part, total - part)


def _trips(**where: object) -> Simple:
    return Simple("trip_count", tuple(where.items()))


# --- fixed values: metrics of the trips model -------------------------------------------------
CORE: dict[str, Metric] = {
    "total_trips": Simple("trip_count"),
    "avg_trip_duration_minutes": Simple("avg_trip_duration"),
    "median_trip_duration_minutes": Simple("median_trip_duration"),
    "avg_trip_distance_miles": Simple("avg_trip_distance"),
    "total_trip_distance_miles": Simple("total_trip_distance"),
    "avg_trip_speed_mph": Simple("avg_speed"),
    "total_passengers": Simple("total_passengers"),
    "avg_passengers_per_trip": Simple("avg_passengers_per_trip"),
    "total_revenue": Simple("total_revenue"),
    "avg_fare": Simple("avg_revenue_per_trip"),
    "revenue_per_mile": Derived(("total_revenue", "total_trip_distance_miles"), _share),
}
_YELLOW, _BIKE = (("trip_type", rules.YELLOW),), (("trip_type", rules.BIKE),)
MODE_SHARE: dict[str, Metric] = {
    "yellow_taxi_trips": _trips(trip_type=rules.YELLOW),
    "fhv_trips": _trips(trip_type=rules.FHV),
    "citibike_trips": _trips(trip_type=rules.BIKE),
    "yellow_taxi_mode_share_pct": Derived(("yellow_taxi_trips", "total_trips"), _share_pct),
    "fhv_mode_share_pct": Derived(("fhv_trips", "total_trips"), _share_pct),
    "citibike_mode_share_pct": Derived(("citibike_trips", "total_trips"), _share_pct),
    "avg_yellow_taxi_fare": Simple("avg_revenue_per_trip", _YELLOW),
    "total_yellow_taxi_revenue": Simple("total_revenue", _YELLOW),
    "avg_citibike_duration": Simple("avg_trip_duration", _BIKE),
    "avg_taxi_duration": Simple("avg_trip_duration", _YELLOW),
    "rush_hour_yellow_taxi_trips": _trips(trip_type=rules.YELLOW, is_rush_hour=True),
    "rush_hour_citibike_trips": _trips(trip_type=rules.BIKE, is_rush_hour=True),
    "weekend_citibike_trips": _trips(trip_type=rules.BIKE, is_weekend=True),
}
TIME_PATTERNS: dict[str, Metric] = {
    "rush_hour_trips": _trips(is_rush_hour=True),
    "weekend_trips": _trips(is_weekend=True),
    "weekday_trips": _trips(is_weekend=False),
    "late_night_trips": _trips(is_late_night=True),
    "business_hours_trips": _trips(is_business_hours=True),
    "rush_hour_trip_rate": Derived(("rush_hour_trips", "total_trips"), _share_pct),
    "weekend_trip_rate": Derived(("weekend_trips", "total_trips"), _share_pct),
    "late_night_trip_rate": Derived(("late_night_trips", "total_trips"), _share_pct),
    **{f"{part}_trips": _trips(day_part=part) for part in rules.DAY_PART_NAMES},
    "avg_weekday_vs_weekend_ratio": Derived(("weekday_trips", "weekend_trips"), _share),
    "rush_hour_vs_non_rush_ratio": Derived(("rush_hour_trips", "total_trips"), _against_rest),
}
# The two rates below are shares, not percentages.
WEATHER_IMPACT: dict[str, Metric] = {
    "trips_in_adverse_weather": _trips(is_adverse_weather=True),
    "trips_in_pleasant_weather": _trips(is_pleasant_weather=True),
    "trips_in_rain": _trips(precipitation_type="rain"),
    "trips_in_snow": _trips(precipitation_type="snow"),
    "citibike_trips_good_cycling_weather": _trips(
        is_good_cycling_weather=True, trip_type=rules.BIKE),
    "adverse_weather_trip_rate": Derived(("trips_in_adverse_weather", "total_trips"), _share),
    "rain_impact_on_trips": Derived(("trips_in_rain", "total_trips"), _share),
    "trips_in_cold_weather": _trips(temp_category="cold"),
    "trips_in_hot_weather": _trips(temp_category="hot"),
    "trips_in_mild_weather": _trips(temp_category="mild"),
    "avg_trip_duration_adverse_weather": Simple(
        "avg_trip_duration", (("is_adverse_weather", True),)),
    "avg_trip_duration_pleasant_weather": Simple(
        "avg_trip_duration", (("is_pleasant_weather", True),)),
}

_CATEGORIES = (
    "day_part", "is_weekend", "is_rush_hour", "is_business_hours", "is_late_night",
    "temp_category", "feels_like_category", "precipitation_type", "precipitation_intensity",
    "wind_category", "cloud_cover_category", "humidity_category", "is_pleasant_weather",
    "is_adverse_weather", "is_good_cycling_weather", "payment_type", "member_type",
    "rideable_type",
)


def _measures(**definitions: tuple[str, str]) -> tuple[Measure, ...]:
    return tuple(Measure(name, agg, expr) for name, (agg, expr) in definitions.items())


TRIPS = SemanticModel(
    name="trips",
    table="fct_trips",
    time="pickup_datetime",
    entities=(
        Entity("trip", "primary", "trip_key"),
        Entity("date", "foreign", "date_key", "date"),
        Entity("time", "foreign", "time_key", "time"),
        Entity("pickup_location", "foreign", "pickup_location_key", "location"),
        Entity("dropoff_location", "foreign", "dropoff_location_key", "location"),
    ),
    dimensions=(
        Dimension("trip_type"),
        Dimension("pickup_datetime", "time", "day"),
        *[Dimension(name) for name in _CATEGORIES],
    ),
    measures=_measures(
        trip_count=("count", "trip_key"),
        avg_trip_duration=("average", "trip_duration_minutes"),
        total_trip_duration=("sum", "trip_duration_minutes"),
        median_trip_duration=("median", "trip_duration_minutes"),
        max_trip_duration=("max", "trip_duration_minutes"),
        avg_trip_distance=("average", "trip_distance"),
        total_trip_distance=("sum", "trip_distance"),
        median_trip_distance=("median", "trip_distance"),
        avg_speed=("average", "avg_speed_mph"),
        total_passengers=("sum", "passenger_count"),
        avg_passengers_per_trip=("average", "passenger_count"),
        total_revenue=("sum", "revenue"),
        avg_revenue_per_trip=("average", "revenue"),
        avg_temperature_celsius=("average", "temperature_celsius"),
        avg_temperature_fahrenheit=("average", "temperature_fahrenheit"),
        avg_precipitation=("average", "precipitation"),
        avg_wind_speed=("average", "wind_speed_mph"),
        avg_humidity=("average", "humidity"),
    ),
    metrics={**CORE, **MODE_SHARE, **TIME_PATTERNS, **WEATHER_IMPACT},
)

HOURLY = SemanticModel(
    name="hourly_mobility",
    table="fct_hourly_mobility",
    time="hour_timestamp",
    entities=(
        Entity("hourly_mobility", "primary", "concat(hour_timestamp, '_', trip_type)"),
        Entity("date", "foreign", "date_key", "date"),
        Entity("time", "foreign", "time_key", "time"),
    ),
    dimensions=(
        Dimension("hour_timestamp", "time", "day"),
        *[Dimension(name) for name in (
            "day_part", "is_weekend", "trip_type", "temp_category", "precipitation_type",
            "has_adverse_weather", "has_pleasant_weather", "has_good_cycling_weather",
        )],
    ),
    measures=_measures(
        total_trips=("sum", "trip_count"),
        hourly_trip_count=("average", "trip_count"),
        yellow_taxi_trips=("sum", "yellow_taxi_count"),
        fhv_trips=("sum", "fhv_count"),
        citibike_trips=("sum", "citibike_count"),
        hourly_avg_trip_duration=("average", "avg_trip_duration_minutes"),
        hourly_avg_trip_distance=("average", "avg_trip_distance_miles"),
        hourly_avg_speed=("average", "avg_speed_mph"),
        hourly_total_passengers=("sum", "total_passengers"),
        hourly_total_revenue=("sum", "total_revenue"),
        yellow_taxi_revenue=("sum", "yellow_taxi_revenue"),
        avg_taxi_fare=("average", "avg_yellow_taxi_fare"),
        citibike_mode_share=("average", "citibike_mode_share_pct"),
        yellow_taxi_mode_share=("average", "yellow_taxi_mode_share_pct"),
        fhv_mode_share=("average", "fhv_mode_share_pct"),
        rush_hour_trips=("sum", "rush_hour_trip_count"),
        rush_hour_percentage=("average", "rush_hour_pct"),
        hourly_avg_temperature_celsius=("average", "avg_temperature_celsius"),
        hourly_avg_temperature_fahrenheit=("average", "avg_temperature_fahrenheit"),
        hourly_avg_precipitation=("average", "avg_precipitation_mm"),
        hourly_avg_wind_speed=("average", "avg_wind_speed_mph"),
        hourly_avg_humidity=("average", "avg_humidity_pct"),
    ),
)

# The older model: fares and durations are spread over all trips, those without included.
TRIPS_BASIC = SemanticModel(
    name="trips_basic",
    table="fct_trips",
    time="pickup_datetime",
    entities=(Entity("trip", "primary", "trip_id"),),
    dimensions=(
        Dimension("pickup_datetime", "time", "hour"),
        Dimension("trip_type"),
        Dimension("is_weekend"),
    ),
    measures=_measures(
        trip_count=("sum", "1"),
        total_revenue=("sum", "revenue"),
        total_distance=("sum", "trip_distance"),
        total_duration_minutes=("sum", "trip_duration_minutes"),
    ),
    metrics={
        "total_trips": Simple("trip_count"),
        "avg_fare_all_trips": Ratio("total_revenue", "trip_count"),
        "avg_duration": Ratio("total_duration_minutes", "trip_count"),
    },
)

MODELS = (TRIPS, HOURLY, TRIPS_BASIC)
