"""Raw tables → typed, renamed and deduplicated relations, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citytrips import rules
from citytrips.functions import surrogate_key, whole
from citytrips.operators.dedup import keep_first

MONEY = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
)

# Columns every mode is brought to, with the type the union has.
UNION_COLUMNS = {
    "trip_id": "string",
    "trip_type": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "pickup_location_id": "string",
    "dropoff_location_id": "string",
    "passenger_count": "int",
    "trip_distance": "double",
    "revenue": "double",
    "payment_type": "int",
    "member_type": "string",
    "rideable_type": "string",
}


def _since(df: DataFrame, column: str, first: str) -> DataFrame:
    """Rows from a date on; a literal bound, so it reaches the Parquet scan."""
    return df.filter(F.col(column) >= F.lit(first).cast("timestamp_ntz"))


def _as_double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


# Columns of a staged mode that the union of all modes takes over.
YELLOW_USED = (
    "trip_id", "pickup_datetime", "dropoff_datetime", "vendor_id", "passenger_count",
    "trip_distance", "pickup_location_id", "dropoff_location_id", "payment_type", "total_amount",
)
FHV_USED = (
    "trip_id", "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
    "pickup_location_id", "dropoff_location_id",
)


def _narrow(df: DataFrame, used: tuple[str, ...], wide: bool) -> DataFrame:
    return df if wide else df.select(*[c for c in df.columns if c in used])


def stg_yellow(raw: DataFrame, min_pickup: str = rules.MIN_PICKUP,
               wide: bool = True) -> DataFrame:
    """Yellow-taxi trips; of several rows with one natural key the dearest stays.

    ``wide=False`` keeps only what the union takes over. Ties are broken by those columns
    first, so both forms keep the same trip, but the narrow one scans and shuffles half the
    columns. The key hash is a function of the natural key and added after the shuffle.
    """
    typed = _since(raw, "tpep_pickup_datetime", min_pickup).select(
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        whole(F.col("vendor_id")).alias("vendor_id"),
        whole(F.col("passenger_count")).alias("passenger_count"),
        *_as_double("trip_distance"),
        whole(F.col("ratecode_id")).alias("ratecode_id"),
        "store_and_fwd_flag",
        whole(F.col("pu_location_id")).alias("pickup_location_id"),
        whole(F.col("do_location_id")).alias("dropoff_location_id"),
        whole(F.col("payment_type")).alias("payment_type"),
        *_as_double(*MONEY),
    )
    key = ("pickup_datetime", "dropoff_datetime", "vendor_id", "pickup_location_id")
    ties = ("total_amount", "dropoff_location_id", "passenger_count", "trip_distance",
            "payment_type")
    kept = keep_first(
        _narrow(typed, YELLOW_USED, wide), key, [F.col(c).desc_nulls_last() for c in ties]
    )
    return kept.select(surrogate_key(*key).alias("trip_id"), *kept.columns)


def stg_fhv(raw: DataFrame, min_pickup: str = rules.MIN_PICKUP, wide: bool = True) -> DataFrame:
    """For-hire trips, one row per natural key."""
    typed = _since(raw, "pickup_datetime", min_pickup).select(
        "dispatching_base_num",
        "affiliated_base_number",
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("drop_off_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        whole(F.col("p_ulocation_id")).alias("pickup_location_id"),
        whole(F.col("d_olocation_id")).alias("dropoff_location_id"),
    )
    key = ("pickup_datetime", "dropoff_datetime", "dispatching_base_num", "pickup_location_id")
    kept = keep_first(
        _narrow(typed, FHV_USED, wide), key, [F.col("dropoff_location_id").desc_nulls_last()]
    )
    return kept.select(surrogate_key(*key).alias("trip_id"), *kept.columns)


def stg_bike(raw: DataFrame) -> DataFrame:
    """Bike trips; the ride id is unique at the source, so no deduplication."""
    return raw.select(
        F.col("ride_id").alias("trip_id"),
        "rideable_type",
        F.col("started_at").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("ended_at").cast("timestamp_ntz").alias("dropoff_datetime"),
        "start_station_name",
        F.col("start_station_id").alias("pickup_location_id"),
        "end_station_name",
        F.col("end_station_id").alias("dropoff_location_id"),
        *_as_double("start_lat", "start_lng", "end_lat", "end_lng"),
        "member_casual",
    )


def stg_weather(raw: DataFrame) -> DataFrame:
    """Hourly weather measurements."""
    return raw.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        *_as_double("temp", "feels_like", "dew_point"),
        whole(F.col("humidity")).alias("humidity"),
        *_as_double("precipitation", "rain", "snowfall"),
        whole(F.col("cloud_cover")).alias("cloud_cover"),
        *_as_double("pressure", "wind_speed"),
        whole(F.col("wind_direction")).alias("wind_direction"),
    )


def _to_union(df: DataFrame, mode: str, **renamed: str) -> DataFrame:
    """Project one mode to the union columns, typed nulls where it has none.

    Location ids are zone numbers for taxis and station codes for bikes, hence text.
    """
    sources = {"trip_type": F.lit(mode)}
    for name in UNION_COLUMNS:
        source = renamed.get(name, name)
        if name not in sources:
            sources[name] = F.col(source) if source in df.columns else F.lit(None)
    return df.select(*[sources[n].cast(kind).alias(n) for n, kind in UNION_COLUMNS.items()])


def trips_unioned(*, yellow: DataFrame | None = None, fhv: DataFrame | None = None,
                  bike: DataFrame | None = None) -> DataFrame:
    """All staged modes in one relation."""
    parts = []
    if yellow is not None:
        parts.append(_to_union(yellow, rules.YELLOW, revenue="total_amount"))
    if fhv is not None:
        parts.append(_to_union(fhv, rules.FHV))
    if bike is not None:
        parts.append(_to_union(bike, rules.BIKE, member_type="member_casual"))
    if not parts:
        raise ValueError("at least one mode is needed")
    return reduce(DataFrame.unionByName, parts)


def filter_trips(fct: DataFrame, start: str | None = None, end: str | None = None,
                 mode: str | None = None) -> DataFrame:
    """Report filter: inclusive dates and an optional mode (``all`` or None for every mode).

    Dates become bounds on the timestamp itself, and on the month partition where there
    is one, so both partition pruning and row-group statistics apply.
    """
    months = "pickup_month" in fct.columns
    pickup = F.col("pickup_datetime")
    if start is not None:
        fct = fct.filter(pickup >= F.lit(start).cast("timestamp_ntz"))
        if months:
            fct = fct.filter(F.col("pickup_month") >= int(start[:4]) * 100 + int(start[5:7]))
    if end is not None:
        after = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
        fct = fct.filter(pickup < after)
        if months:
            fct = fct.filter(F.col("pickup_month") <= int(end[:4]) * 100 + int(end[5:7]))
    if mode not in (None, "all"):
        fct = fct.filter(F.col("trip_type") == mode)
    return fct


def date_bounds(trips: DataFrame) -> DataFrame:
    """First and last pickup date."""
    day = F.to_date("pickup_datetime")
    return trips.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))
