"""Raw tables projected from general-purpose order, line-item and event tables.

There is no trip data at hand to test with, so trips are derived row by row from other
tables: a line item becomes a yellow-taxi trip, an order a for-hire trip, an event a bike
trip, and every hour with a pickup gets weather. Distances, amounts and measurements are
multiples of small powers of two, so sums of them are exact in any order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips import rules, schemas
from citytrips.functions import floor_hour
from citytrips.plans.pipeline import Store
from citytrips.sources.columns import conform

MIN_PICKUP = "1995-01-01"
BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR")
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports", "EWR")
ZONE_COUNT = 265
NAMED_ZONES = tuple(dict.fromkeys(
    rules.HIGH_DEMAND_ZONES + rules.HUB_ZONES + rules.TOURIST_ZONES + rules.BUSINESS_ZONES
))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts.cast("timestamp_ntz") + F.make_dt_interval(mins=minutes.cast("int"))


def raw_yellow(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as yellow-taxi trips; every tenth order has copies with a lower amount."""
    order = F.col("l_orderkey")
    copies = F.when(order % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    items = _table(spark, folder, "lineitem").withColumn("copy", F.explode(copies))
    pickup = _plus_minutes(F.col("l_shipdate"), order % 1440)
    return conform(items.select(
        (F.col("l_suppkey") % 2 + 1).alias("vendor_id"),
        pickup.alias("tpep_pickup_datetime"),
        _plus_minutes(pickup, F.col("l_quantity")).alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        (F.col("l_quantity") * 0.25 + F.col("l_linenumber") * 0.5).alias("trip_distance"),
        (F.col("l_partkey") % ZONE_COUNT + 1).alias("pu_location_id"),
        (F.col("l_suppkey") % ZONE_COUNT + 1).alias("do_location_id"),
        (F.col("l_linenumber") % 6 + 1).alias("payment_type"),
        (F.floor("l_extendedprice") / 1024.0 - F.col("copy")).alias("total_amount"),
    ), schemas.RAW_YELLOW)


def raw_fhv(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as for-hire trips; every sixth has no drop-off time."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    pickup = _plus_minutes(F.col("o_orderdate"), order % 1440)
    return conform(_table(spark, folder, "orders").select(
        F.concat(F.lit("B"), F.lpad(customer.cast("string"), 5, "0"))
        .alias("dispatching_base_num"),
        pickup.alias("pickup_datetime"),
        F.when(order % 6 != 0, _plus_minutes(pickup, customer % 60)).alias("drop_off_datetime"),
        F.when(F.col("o_orderstatus") != "P", customer % ZONE_COUNT + 1).alias("p_ulocation_id"),
        (order % ZONE_COUNT + 1).alias("d_olocation_id"),
    ), schemas.RAW_FHV)


def raw_bike(spark: SparkSession, folder: str) -> DataFrame:
    """Events as bike trips."""
    event, user = F.col("event_id"), F.col("user_id")
    kinds = F.array(*[F.lit(k) for k in rules.RIDEABLE_TYPES])
    return conform(_table(spark, folder, "events").select(
        F.concat(F.lit("R"), event.cast("string")).alias("ride_id"),
        F.element_at(kinds, (event % 3 + 1).cast("int")).alias("rideable_type"),
        F.col("ts").alias("started_at"),
        _plus_minutes(F.col("ts"), event % 90).alias("ended_at"),
        F.concat(user.cast("string"), F.lit(".10")).alias("start_station_id"),
        F.concat((event % 150).cast("string"), F.lit(".20")).alias("end_station_id"),
        F.when(user % 2 == 0, "member").otherwise("casual").alias("member_casual"),
    ), schemas.RAW_BIKE)


def _hour_number(hour: Column) -> Column:
    """Whole hours since 1970."""
    return F.datediff(F.to_date(hour), F.lit("1970-01-01").cast("date")).cast("long") * 24 + (
        F.hour(hour)
    )


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Weather of every hour with a pickup, except a few hours left out on purpose."""
    pickups = (
        raw_yellow(spark, folder).select(F.col("tpep_pickup_datetime").alias("ts"))
        .unionByName(raw_fhv(spark, folder).select(F.col("pickup_datetime").alias("ts")))
        .unionByName(raw_bike(spark, folder).select(F.col("started_at").alias("ts")))
    )
    h, temp = F.col("h"), F.col("temp")
    hours = (
        pickups.select(floor_hour(F.col("ts")).alias("timestamp")).distinct()
        .withColumn("h", _hour_number(F.col("timestamp")))
        .filter(h % 97 != 0)
    )
    shower = (
        F.when(h % 211 == 0, 64.0).when(h % 5 == 0, (h % 13) * 0.75)
        .when(h % 11 == 3, 0.0625).when(h % 11 == 5, 0.25).otherwise(0.0)
    )
    snow = F.when((h % 47 < 10) & (h % 7 == 0), (h % 9) * 0.875).otherwise(0.0)
    return conform(hours.withColumns({
        "temp": (h % 47) - 8 + (h % 4) * 0.25, "rain": shower, "snowfall": snow,
    }).withColumns({
        "feels_like": temp - 2,
        "humidity": h % 101,
        "dew_point": temp - 5,
        "precipitation": F.col("rain") + F.col("snowfall"),
        "cloud_cover": (h * 7) % 101,
        "pressure": (h % 50 + 990).cast("double"),
        "wind_speed": (h % 23).cast("double"),
        "wind_direction": (h * 37) % 361,
    }), schemas.RAW_WEATHER)


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """The zones taxi trips start or end in, with made-up attributes."""
    yellow, fhv = raw_yellow(spark, folder), raw_fhv(spark, folder)
    ids = yellow.select(F.explode(F.array("pu_location_id", "do_location_id")).alias("n"))
    ids = ids.unionByName(
        fhv.select(F.explode(F.array("p_ulocation_id", "d_olocation_id")).alias("n"))
    )
    n = F.col("n")

    def pick(names: tuple[str, ...], index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in names]), index.cast("int"))

    return conform(ids.filter("n is not null").distinct().select(
        n.alias("location_id"),
        F.when(n == ZONE_COUNT, "Unknown").otherwise(pick(BOROUGHS, n % 6 + 1)).alias("borough"),
        F.when(n <= len(NAMED_ZONES), pick(NAMED_ZONES, F.least(n, F.lit(len(NAMED_ZONES)))))
        .otherwise(F.concat(F.lit("Zone "), n.cast("string"))).alias("zone"),
        pick(SERVICE_ZONES, n % 4 + 1).alias("service_zone"),
    ), schemas.ZONES)


class ProjectedStore(Store):
    """A store whose raw tables are the projections above instead of loaded files."""

    def __init__(self, spark: SparkSession, root: str, folder: str):
        super().__init__(spark, root, MIN_PICKUP)
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        source = {"yellow_taxi": raw_yellow, "fhv_taxi": raw_fhv, "trips": raw_bike,
                  "hourly_weather": raw_weather}[name]
        return source(self.spark, self.folder)

    def zones(self) -> DataFrame:
        return zones(self.spark, self.folder)
