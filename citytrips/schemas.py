"""Declared schemas of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _DOUBLE, _TEXT, _TIME = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW_YELLOW = _schema(
    vendor_id=_LONG,
    tpep_pickup_datetime=_TIME,
    tpep_dropoff_datetime=_TIME,
    passenger_count=_LONG,
    trip_distance=_DOUBLE,
    ratecode_id=_LONG,
    store_and_fwd_flag=_TEXT,
    pu_location_id=_LONG,
    do_location_id=_LONG,
    payment_type=_LONG,
    fare_amount=_DOUBLE,
    extra=_DOUBLE,
    mta_tax=_DOUBLE,
    tip_amount=_DOUBLE,
    tolls_amount=_DOUBLE,
    improvement_surcharge=_DOUBLE,
    total_amount=_DOUBLE,
    congestion_surcharge=_DOUBLE,
    airport_fee=_DOUBLE,
    cbd_congestion_fee=_DOUBLE,
)

RAW_FHV = _schema(
    dispatching_base_num=_TEXT,
    pickup_datetime=_TIME,
    drop_off_datetime=_TIME,
    affiliated_base_number=_TEXT,
    p_ulocation_id=_LONG,
    d_olocation_id=_LONG,
)

RAW_BIKE = _schema(
    ride_id=_TEXT,
    rideable_type=_TEXT,
    started_at=_TIME,
    ended_at=_TIME,
    start_station_name=_TEXT,
    start_station_id=_TEXT,
    end_station_name=_TEXT,
    end_station_id=_TEXT,
    start_lat=_DOUBLE,
    start_lng=_DOUBLE,
    end_lat=_DOUBLE,
    end_lng=_DOUBLE,
    member_casual=_TEXT,
)

RAW_WEATHER = _schema(
    timestamp=_TIME,
    temp=_DOUBLE,
    feels_like=_DOUBLE,
    humidity=_LONG,
    dew_point=_DOUBLE,
    precipitation=_DOUBLE,
    rain=_DOUBLE,
    snowfall=_DOUBLE,
    cloud_cover=_LONG,
    pressure=_DOUBLE,
    wind_speed=_DOUBLE,
    wind_direction=_LONG,
)

ZONES = _schema(
    location_id=T.IntegerType(),
    borough=_TEXT,
    zone=_TEXT,
    service_zone=_TEXT,
)

# Natural keys by which a batch replaces rows of a raw table.
KEYS = {
    "yellow_taxi": ("tpep_pickup_datetime", "tpep_dropoff_datetime", "vendor_id", "pu_location_id"),
    "fhv_taxi": ("pickup_datetime", "drop_off_datetime", "dispatching_base_num"),
    "trips": ("ride_id",),
    "hourly_weather": ("timestamp",),
}
RAW = {
    "yellow_taxi": RAW_YELLOW,
    "fhv_taxi": RAW_FHV,
    "trips": RAW_BIKE,
    "hourly_weather": RAW_WEATHER,
}
EVENT_TIME = {
    "yellow_taxi": "tpep_pickup_datetime",
    "fhv_taxi": "pickup_datetime",
    "trips": "started_at",
    "hourly_weather": "timestamp",
}
