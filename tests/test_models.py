"""Staging, dimensions and facts on rows written by hand."""

from __future__ import annotations

from datetime import datetime

from citytrips import rules, schemas
from citytrips.operators import dims, facts, staging
from citytrips.sources.columns import conform
from conftest import values
from pyspark.sql import functions as F


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark, schema, *rows: dict):
    """Rows given by some columns, nulls in the rest."""
    data = [tuple(r.get(n) for n in schema.fieldNames()) for r in rows]
    return spark.createDataFrame(data, schema)


def yellow(spark, *rows):
    base = {"vendor_id": 1, "tpep_pickup_datetime": at("2025-03-01 08:00:30"),
            "tpep_dropoff_datetime": at("2025-03-01 08:20:10"), "pu_location_id": 161,
            "do_location_id": 10, "trip_distance": 5.0, "total_amount": 20.0,
            "passenger_count": 2, "payment_type": 1}
    return frame(spark, schemas.RAW_YELLOW, *[{**base, **r} for r in rows])


def weather(spark, *rows):
    base = {"timestamp": at("2025-03-01 08:00:00"), "temp": 12.0, "feels_like": 10.0,
            "humidity": 50, "precipitation": 0.0, "rain": 0.0, "snowfall": 0.0,
            "cloud_cover": 10, "wind_speed": 3.0, "wind_direction": 90}
    return dims.dim_weather(staging.stg_weather(
        frame(spark, schemas.RAW_WEATHER, *[{**base, **r} for r in rows])))


def test_yellow_keeps_the_dearest_copy(spark):
    raw = yellow(spark, {"total_amount": 5.0}, {"total_amount": 9.0}, {"total_amount": None},
                 {"pu_location_id": 7, "total_amount": None},
                 {"tpep_pickup_datetime": at("2024-12-31 23:59:59")})
    for wide in (True, False):
        kept = staging.stg_yellow(raw, wide=wide)
        assert values(kept, "pickup_location_id", "total_amount") == [(161, 9.0), (7, None)]
    full = staging.stg_yellow(raw)
    assert len(full.columns) == 21 and dict(full.dtypes)["passenger_count"] == "int"
    assert full.select("trip_id").distinct().count() == 2


def test_for_hire_null_dropoff_is_part_of_the_key(spark):
    row = {"dispatching_base_num": "B1", "pickup_datetime": at("2025-05-01 10:00:00")}
    raw = frame(spark, schemas.RAW_FHV, row, row, {**row, "p_ulocation_id": 5},
                {**row, "drop_off_datetime": at("2025-05-01 10:30:00")})
    assert staging.stg_fhv(raw).count() == 3


def test_union_takes_zone_numbers_and_station_codes(spark):
    bike = frame(spark, schemas.RAW_BIKE, {
        "ride_id": "R1", "started_at": at("2025-03-01 09:00:00"), "start_station_id": "7531.10",
        "rideable_type": "classic_bike", "member_casual": "member"})
    trips = staging.trips_unioned(
        yellow=staging.stg_yellow(yellow(spark, {}), wide=False), bike=staging.stg_bike(bike))
    assert values(trips, "trip_type", "pickup_location_id", "member_type", "revenue") == [
        ("citibike", "7531.10", "member", None), ("yellow_taxi", "161", None, 20.0)]
    assert dict(trips.dtypes) == {
        **staging.UNION_COLUMNS}


def test_filters(spark):
    trips = spark.createDataFrame(
        [(at(t), m) for t, m in (("2025-01-01 00:00:00", "fhv"), ("2025-01-31 23:59:59", "fhv"),
                                 ("2025-02-01 00:00:00", "fhv"), ("2025-01-10 12:00:00", "citibike"))],
        "pickup_datetime timestamp_ntz, trip_type string")
    assert staging.filter_trips(trips, "2025-01-01", "2025-01-31").count() == 3
    assert staging.filter_trips(trips, "2025-01-01", "2025-01-31", "fhv").count() == 2
    assert staging.filter_trips(trips, mode="all").count() == 4
    assert [str(v) for v in staging.date_bounds(trips).first()] == ["2025-01-01", "2025-02-01"]


def test_precipitation_and_description(spark):
    cases = [  # precipitation, rain, snow, temp, cloud → type, description
        (0.0, 0.0, 0.0, 12.0, 10, "none", "clear"),
        (3.0, 1.0, 2.0, 1.0, 10, "mixed", "snow"),
        (2.0, 0.0, 2.0, 1.0, 10, "snow", "snow"),
        (2.0, 2.0, 0.0, 5.0, 10, "rain", "light_rain"),
        (2.0, 0.0, 0.0, 5.0, 80, "none", "cloudy"),
        (None, None, None, 5.0, 51, "none", "partly_cloudy"),
        (11.0, 11.0, 0.0, -1.0, 10, "rain", "blizzard"),
        (11.0, 11.0, 0.0, 1.0, 10, "rain", "severe_storm"),
        (11.0, 11.0, 0.0, None, 10, "rain", "severe_storm"),
        (5.1, 0.0, 5.1, 0.0, 10, "snow", "heavy_snow"),
        (7.7, 7.7, 0.0, 9.0, 10, "rain", "heavy_rain"),
        (2.6, 2.6, 0.0, 9.0, 10, "rain", "moderate_rain"),
        (0.0, 0.0, 0.0, 9.0, 76, "none", "cloudy"),
        (0.0, 0.0, 0.0, 9.0, 50, "none", "clear"),
        (0.0, 0.0, 0.0, 9.0, None, "none", "clear"),
    ]
    rows = [{"timestamp": datetime(2025, 1, 1, i), "precipitation": p, "rain": r, "snowfall": s,
             "temp": t, "cloud_cover": c} for i, (p, r, s, t, c, *_) in enumerate(cases)]
    got = weather(spark, *rows).orderBy("timestamp").select(
        "precipitation_type", "weather_description").collect()
    assert [tuple(g) for g in got] == [c[5:] for c in cases]


def test_comfort_flags(spark):
    cases = [  # temp, precipitation, wind, cloud → pleasant, adverse, cycling
        (15.0, 0.0, 9.9, 49, True, False, True),
        (25.0, 0.0, 10.0, 49, False, False, True),
        (25.1, 0.0, 5.0, 10, False, False, False),
        (14.9, 0.0, 5.0, 10, False, False, True),
        (10.0, 0.0, 15.0, 10, False, False, False),
        (20.0, 5.1, 5.0, 10, False, True, False),
        (20.0, 5.0, 5.0, 10, False, False, False),
        (-5.1, 0.0, 5.0, 10, False, True, False),
        (35.1, 0.0, 5.0, 10, False, True, False),
        (None, 0.0, 16.0, 10, False, True, False),
        (None, None, None, None, False, False, False),
    ]
    rows = [{"timestamp": datetime(2025, 1, 1, i), "temp": t, "precipitation": p, "wind_speed": w,
             "cloud_cover": c} for i, (t, p, w, c, *_) in enumerate(cases)]
    got = weather(spark, *rows).orderBy("timestamp").select(
        "is_pleasant_weather", "is_adverse_weather", "is_good_cycling_weather").collect()
    assert [tuple(g) for g in got] == [c[4:] for c in cases]


def test_units(spark):
    row = weather(spark, {"temp": 0.25, "wind_speed": 10.0}).first()
    assert (row["temp_fahrenheit"], row["wind_speed_mph"]) == (32.5, 22.4)


def test_hour_dimension(spark):
    rows = {r["hour"]: r for r in dims.dim_time(spark).collect()}
    assert len(rows) == 24
    assert (rows[0]["hour_12"], rows[12]["hour_12"], rows[13]["hour_12"]) == (12, 12, 1)
    assert (rows[11]["am_pm"], rows[12]["am_pm"]) == ("AM", "PM")
    labels = [rows[h]["time_period"] for h in (0, 5, 6, 9, 12, 15, 18, 21, 23)]
    assert labels == ["overnight", "overnight", *list(rules.TIME_PERIODS)[1:], "late_night"]


def test_spine_leaves_out_its_end(spark):
    days = [r[0].isoformat() for r in dims.time_spine(spark).collect()]
    assert (days[0], days[-1], len(days)) == ("2025-09-01", "2025-12-31", 122)


def test_location_flags(spark):
    zones = spark.createDataFrame([
        (1, "EWR", "Newark Airport", "EWR"), (2, "Manhattan", "Midtown Center", "Yellow Zone"),
        (3, "Queens", "JFK Airport", "Airports"), (4, None, "Nowhere", None),
    ], schemas.ZONES)
    rows = {r["location_id"]: r for r in dims.dim_location(zones).collect()}
    assert (rows[1]["location_tier"], rows[1]["borough_region"]) == ("airport", "Airport")
    assert rows[1]["is_airport"] and rows[1]["is_transportation_hub"]
    assert rows[2]["is_high_demand_zone"] and rows[2]["is_business_district"]
    assert rows[3]["is_airport"] and not rows[3]["is_boro_zone"]
    assert (rows[4]["location_tier"], rows[4]["borough_region"]) == ("unknown", "Other")
    assert not rows[4]["is_yellow_zone"] and not rows[4]["is_airport"]


def test_trip_fact(spark):
    raw = yellow(spark, {}, {"vendor_id": 2, "tpep_dropoff_datetime": at("2025-03-01 08:00:40")},
                 {"vendor_id": 3, "tpep_pickup_datetime": at("2025-03-01 11:00:00"),
                  "tpep_dropoff_datetime": None})
    trips = staging.trips_unioned(yellow=staging.stg_yellow(conform(raw, schemas.RAW_YELLOW)))
    fct = facts.fct_trips(trips, weather(spark, {}))
    assert fct.columns == [*facts.TRIP_COLUMNS, "pickup_month"] and len(facts.TRIP_COLUMNS) == 46
    assert values(fct, "trip_duration_minutes", "avg_speed_mph", "temp_category", "is_weekend") == [
        (0, None, "mild", True), (20, 15.0, "mild", True), (None, None, None, True)]
    assert {r[0] for r in fct.select("pickup_month").collect()} == {202503}


def test_hourly_fact(spark):
    raw = yellow(spark, {}, {"vendor_id": 2, "total_amount": 30.0, "trip_distance": 8.0,
                             "tpep_dropoff_datetime": at("2025-03-01 08:10:00")},
                 {"vendor_id": 3, "tpep_pickup_datetime": at("2025-03-01 11:00:00")})
    trips = staging.trips_unioned(yellow=staging.stg_yellow(raw))
    hourly = facts.fct_hourly(facts.fct_trips(trips, weather(spark, {"temp": 20.0})))
    rows = {r["time_key"]: r for r in hourly.collect()}
    assert set(rows) == {"8", "11"}
    eight = rows["8"]
    assert (eight["trip_count"], eight["total_revenue"]) == (2, 50.0)
    assert eight["median_trip_duration_minutes"] == 15.0
    assert eight["yellow_taxi_mode_share_pct"] == 100.0 and eight["fhv_count"] == 0
    assert eight["rush_hour_pct"] == 100.0 and eight["has_pleasant_weather"] == 1
    assert rows["11"]["temp_category"] is None and rows["11"]["has_pleasant_weather"] == 0
    assert hourly.filter(F.col("hour_key").isNull()).isEmpty()
