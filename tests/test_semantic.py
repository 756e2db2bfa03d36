"""Models, metrics and queries."""

from __future__ import annotations

from datetime import datetime

import pytest
from citytrips.operators.dims import time_spine
from citytrips.plans import metrics
from citytrips.plans.semantic import Derived, Ratio, Simple, at_grain, catalog, query
from conftest import values
from pyspark.sql import functions as F

TYPES = {"trip_duration_minutes": "bigint", "pickup_datetime": "timestamp_ntz",
         "is_rush_hour": "boolean", "is_weekend": "boolean", "revenue": "double",
         "trip_distance": "double"}


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        # key, type, time, rush, weekend, revenue, miles, minutes, date
        ("1", "yellow_taxi", datetime(2025, 9, 1, 8), True, False, 10.0, 2.0, 10, "2025-09-01"),
        ("2", "yellow_taxi", datetime(2025, 9, 1, 12), False, False, 20.0, 4.0, 30, "2025-09-01"),
        ("3", "citibike", datetime(2025, 9, 3, 8), True, False, None, None, 5, "2025-09-03"),
        ("4", "citibike", datetime(2025, 9, 6, 9), True, True, None, None, 7, "2025-09-06"),
    ]
    fct = spark.createDataFrame(
        rows, "trip_key string, trip_type string, pickup_datetime timestamp_ntz,"
        " is_rush_hour boolean, is_weekend boolean, revenue double, trip_distance double,"
        " trip_duration_minutes bigint, date_key string")
    dates = spark.createDataFrame([("2025-09-01", 36), ("2025-09-03", 36)],
                                  "date_key string, week_of_year int")
    return {"fct_trips": fct, "date": dates,
            "spine": time_spine(spark, "2025-09-01", "2025-09-05")}


def test_inventory(spark):
    trips, hourly, basic = metrics.MODELS
    assert (len(trips.entities), len(trips.dimensions), len(trips.measures)) == (5, 20, 18)
    assert (len(hourly.entities), len(hourly.dimensions), len(hourly.measures)) == (3, 9, 22)
    assert (len(basic.dimensions), len(basic.measures)) == (3, 4)
    assert [len(g) for g in (metrics.CORE, metrics.MODE_SHARE, metrics.TIME_PATTERNS,
                             metrics.WEATHER_IMPACT)] == [11, 13, 14, 12]
    assert len(trips.metrics) == 50 and len(basic.metrics) == 3
    kinds = {type(m) for m in (*trips.metrics.values(), *basic.metrics.values())}
    assert kinds == {Simple, Derived, Ratio}
    assert catalog(spark, *metrics.MODELS).count() == 53


def test_simple_filtered_and_derived(tables):
    got = query(metrics.TRIPS, tables, [
        "total_trips", "rush_hour_trips", "avg_fare", "revenue_per_mile",
        "rush_hour_citibike_trips", "rush_hour_trip_rate", "avg_weekday_vs_weekend_ratio",
        "rush_hour_vs_non_rush_ratio", "median_trip_duration_minutes", "citibike_mode_share_pct",
    ]).first()
    assert tuple(got) == (4, 3, 15.0, 5.0, 2, 75.0, 3.0, 3.0, 8.5, 50.0)


def test_one_aggregation_serves_all_metrics(tables):
    names = ["yellow_taxi_mode_share_pct", "fhv_mode_share_pct", "avg_trip_duration_minutes"]
    plan = query(metrics.TRIPS, tables, names)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("LogicalRDD") == 1


def test_division_by_zero_gives_null(tables):
    got = query(metrics.TRIPS, tables, ["avg_weekday_vs_weekend_ratio"], ["trip_type"])
    assert values(got) == [("citibike", 1.0), ("yellow_taxi", None)]


def test_older_fare_spreads_over_all_trips(tables):
    row = query(metrics.TRIPS_BASIC, tables, ["avg_fare_all_trips", "avg_duration"]).first()
    assert tuple(row) == (7.5, 13.0)


def test_joined_dimension_keeps_trips_without_one(tables):
    got = query(metrics.TRIPS, tables, ["total_trips"], ["date__week_of_year"])
    assert values(got) == [(36, 3), (None, 1)]
    some = query(metrics.TRIPS, tables, ["total_trips"], ["trip_type"],
                 where="date__week_of_year = 36", joined=["date__week_of_year"])
    assert values(some) == [("citibike", 1), ("yellow_taxi", 2)]


def test_grain_fill_order_and_limit(tables):
    days = query(metrics.TRIPS, tables, ["total_trips"], ["metric_time"], grain="day", fill=True,
                 order_by=["metric_time"])
    assert [r["total_trips"] for r in days.collect()] == [2, None, 1, None, 1]  # one after the spine
    weeks = query(metrics.TRIPS, tables, ["total_trips"], ["metric_time"], grain="week")
    assert values(weeks) == [(datetime(2025, 9, 1), 4)]
    top = query(metrics.TRIPS, tables, ["total_trips"], ["pickup_datetime"],
                order_by=[F.desc("total_trips")], limit=1)
    assert values(top) == [(datetime(2025, 9, 1), 2)]


def test_grains(spark):
    df = spark.createDataFrame([(datetime(2025, 8, 20, 13, 45),)], "t timestamp_ntz")
    got = df.select(*[at_grain(F.col("t"), g) for g in (
        "hour", "day", "week", "month", "quarter", "year")]).first()
    assert [v.strftime("%m-%d %H") for v in got] == [
        "08-20 13", "08-20 00", "08-18 00", "08-01 00", "07-01 00", "01-01 00"]


def test_unknown_names_are_rejected(tables):
    with pytest.raises(KeyError):
        query(metrics.TRIPS, tables, ["no_such_metric"])
    with pytest.raises(KeyError):
        query(metrics.TRIPS, tables, ["total_trips"], ["no_such_dimension"])
    with pytest.raises(KeyError):
        query(metrics.TRIPS, tables, ["total_trips"], ["weather__temp"])


def test_filling_keeps_periods_outside_the_spine(spark, tables):
    short = {**tables, "spine": time_spine(spark, "2025-09-03", "2025-09-05")}
    days = query(metrics.TRIPS, short, ["total_trips"], ["metric_time"], grain="day", fill=True)
    assert values(days) == [
        (datetime(2025, 9, 1), 2), (datetime(2025, 9, 3), 1), (datetime(2025, 9, 4), None),
        (datetime(2025, 9, 6), 1)]
    with pytest.raises(ValueError):
        query(metrics.TRIPS, short, ["total_trips"], ["trip_type"], fill=True)
