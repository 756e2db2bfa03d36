"""Queries over kept states equal those over the fact, and only go there where they can."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from citytrips.functions import floor_hour
from citytrips.plans import metrics, rollups
from citytrips.plans.rollups import MODE_DAYS, TRIP_HOURS, TRIP_MONTHS, Rollup, choose, navigate
from citytrips.plans.semantic import query
from conftest import values
from pyspark.sql import functions as F

NUMBERS = ("trip_duration_minutes", "trip_distance", "avg_speed_mph", "passenger_count", "revenue",
           "temperature_celsius", "temperature_fahrenheit", "precipitation", "wind_speed_mph", "humidity")
FLAGS = ("is_rush_hour", "is_business_hours", "is_late_night", "is_pleasant_weather",
         "is_adverse_weather", "is_good_cycling_weather")
WORDS = {"day_part": ("morning", "night", None), "temp_category": ("cold", "hot", "mild", None),
         "feels_like_category": ("cold", None), "precipitation_type": ("rain", "snow", "none", None),
         "precipitation_intensity": ("light", None), "wind_category": ("calm", "windy"),
         "cloud_cover_category": ("clear", None), "humidity_category": ("dry", "humid"),
         "payment_type": ("cash", "card")}


def _rows(n, seed=4):
    """Trips with nulls everywhere; numbers are halves, so their sums are exact."""
    r = random.Random(seed)
    some = lambda v: None if r.random() < 0.15 else v
    rows = []
    for i in range(n):
        ts = datetime(2025, 1, 27) + timedelta(minutes=r.randint(0, 90_000))
        rows.append((f"{seed}-{i}", some(r.choice(["yellow_taxi", "fhv", "citibike"])), ts,
                     f"{ts:%Y-%m-%d}", r.random() < 0.3, *[some(r.random() < 0.5) for _ in FLAGS],
                     *[some(r.choice(w)) for w in WORDS.values()],
                     *[some(r.randint(0, 60) / 2) for _ in NUMBERS]))
    return rows


SCHEMA = ", ".join(["trip_key string", "trip_type string", "pickup_datetime timestamp_ntz", "date_key string",
                    "is_weekend boolean", *[f"{c} boolean" for c in FLAGS], *[f"{c} string" for c in WORDS],
                    *[f"{c} double" for c in NUMBERS]])


def _fact(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("time_key", F.hour("pickup_datetime").cast("string"))


@pytest.fixture(scope="module")
def tables(spark):
    dates = spark.range(40).select(
        F.date_add(F.lit("2025-01-27").cast("date"), F.col("id").cast("int")).alias("d")).select(
        F.col("d").cast("string").alias("date_key"), F.weekofyear("d").alias("week_of_year"))
    return {"fct_trips": _fact(spark, _rows(400)).cache(), "date": dates}


@pytest.fixture(scope="module")
def kept(tables):
    hours = rollups.build(metrics.TRIPS, tables["fct_trips"], TRIP_HOURS).cache()
    return {TRIP_HOURS: hours, **{
        r: rollups.derive(metrics.TRIPS, hours, TRIP_HOURS, r).cache() for r in (TRIP_MONTHS, MODE_DAYS)}}


METRICS = [n for n in metrics.TRIPS.metrics if not n.startswith("median")]
MEASURES = [m.name for m in metrics.TRIPS.measures if m.agg != "median"]
QUESTIONS = [
    (TRIP_MONTHS, METRICS, {}),
    (TRIP_MONTHS, MEASURES, {"group_by": ["metric_time", "temp_category"], "grain": "year"}),
    (TRIP_MONTHS, METRICS, {"group_by": ["trip_type"], "where": "is_rush_hour or day_part is null"}),
    (MODE_DAYS, ["total_trips", "weekend_trips", "max_trip_duration"], {"group_by": ["metric_time"], "grain": "week"}),
    (MODE_DAYS, ["avg_fare"], {"group_by": ["date__week_of_year", "trip_type"]}),
    (TRIP_HOURS, METRICS, {"group_by": ["metric_time"], "grain": "hour"}),
    (TRIP_HOURS, MEASURES, {"group_by": ["pickup_datetime", "precipitation_type"]}),
    (TRIP_HOURS, ["trips_in_rain"], {"group_by": ["trip_type"], "where": "date__week_of_year = 6",
                                     "joined": ["date__week_of_year"]}),
    (None, ["total_trips", "median_trip_duration_minutes"], {}),
    (None, ["total_trips"], {"group_by": ["payment_type"]}),
    (None, ["total_trips"], {"where": "minute(pickup_datetime) < 30"}),
    (None, ["total_trips"], {"where": "revenue > 5"}),
    (None, ["total_trips"], {"where": "payment_type = 'cash'", "group_by": ["trip_type"]}),
]


@pytest.mark.parametrize("question", range(len(QUESTIONS)))
def test_states_and_fact_give_equal_results(tables, kept, question):
    rollup, names, options = QUESTIONS[question]
    assert choose(metrics.TRIPS, tables, kept, names, **options) == rollup
    found = navigate(metrics.TRIPS, tables, kept, names, **options)
    expected = query(metrics.TRIPS, tables, names, **options)
    assert found.dtypes == expected.dtypes
    assert values(found) == values(expected)


def test_unknown_names_and_wrong_filters_are_errors(tables, kept):
    from pyspark.errors import AnalysisException

    with pytest.raises(KeyError):
        navigate(metrics.TRIPS, tables, kept, ["no_such_metric"])
    with pytest.raises(KeyError):
        navigate(metrics.TRIPS, tables, kept, ["total_trips"], ["no_such_dimension"])
    with pytest.raises(AnalysisException):
        navigate(metrics.TRIPS, tables, kept, ["total_trips"], where="no_such_column = 1")


def test_basic_model_and_ratios(spark, tables):
    days = Rollup("day", ("trip_type", "is_weekend"))
    kept = {days: rollups.build(metrics.TRIPS_BASIC, tables["fct_trips"], days)}
    names = list(metrics.TRIPS_BASIC.metrics)
    assert choose(metrics.TRIPS_BASIC, tables, kept, names, ["pickup_datetime"]) is None  # hours
    for options in ({}, {"group_by": ["trip_type"]}, {"group_by": ["metric_time"], "grain": "month"}):
        assert choose(metrics.TRIPS_BASIC, tables, kept, names, **options) == days
        assert values(navigate(metrics.TRIPS_BASIC, tables, kept, names, **options)) == values(
            query(metrics.TRIPS_BASIC, tables, names, **options))


def test_further_rows_are_merged(spark, tables, kept):
    more = _fact(spark, _rows(150, seed=9))
    both = {"fct_trips": tables["fct_trips"].unionByName(more), "date": tables["date"]}
    hours = rollups.merge(metrics.TRIPS, kept[TRIP_HOURS],
                          rollups.build(metrics.TRIPS, more, TRIP_HOURS), TRIP_HOURS)
    for options in ({}, {"group_by": ["metric_time", "trip_type"], "grain": "month"}):
        assert values(navigate(metrics.TRIPS, both, {TRIP_HOURS: hours}, METRICS, **options)) == values(
            query(metrics.TRIPS, both, METRICS, **options))


def test_empty_fact_and_impossible_derivations(spark, tables):
    none = {"fct_trips": tables["fct_trips"].limit(0), "date": tables["date"]}
    kept = {TRIP_MONTHS: rollups.build(metrics.TRIPS, none["fct_trips"], TRIP_MONTHS)}
    assert values(navigate(metrics.TRIPS, none, kept, METRICS)) == values(query(metrics.TRIPS, none, METRICS))
    assert navigate(metrics.TRIPS, none, kept, METRICS, ["trip_type"]).count() == 0
    with pytest.raises(ValueError):
        rollups.derive(metrics.TRIPS, kept[TRIP_MONTHS], TRIP_MONTHS, TRIP_HOURS)
    with pytest.raises(ValueError):
        rollups.derive(metrics.TRIPS, kept[TRIP_MONTHS], Rollup("week"), Rollup("month"))


def test_hours_hold_one_row_for_each_period_and_combination(tables, kept):
    keys = [floor_hour(F.col("pickup_datetime")), *TRIP_HOURS.dimensions, "date_key", "time_key"]
    assert kept[TRIP_HOURS].count() == tables["fct_trips"].select(*keys).distinct().count()
