"""Column expressions at their boundaries, against values worked out by hand."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from citytrips import functions as fn
from citytrips import rules
from pyspark.sql import functions as F


def each(spark, kind, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i")
            .select("y").collect()]


@pytest.mark.parametrize("bands, inputs, labels", [
    (rules.TEMPERATURE, [-0.1, 0.0, 9.9, 10.0, 19.9, 20.0, 29.9, 30.0, None],
     ["cold", "cool", "cool", "mild", "mild", "warm", "warm", "hot", "hot"]),
    (rules.FEELS_LIKE, [-0.1, 0.0, 9.9, 10.0, 19.9, 20.0, 29.9, 30.0, None],
     ["very_cold", "cold", "cold", "comfortable", "comfortable", "warm", "warm", "hot", "hot"]),
    (rules.WIND, [4.9, 5.0, 9.9, 10.0, 14.9, 15.0, 19.9, 20.0, None],
     ["calm", "breezy", "breezy", "windy", "windy", "very_windy", "very_windy", "strong",
      "strong"]),
    (rules.INTENSITY, [2.4, 2.5, 7.5, 7.6, 49.9, 50.0, None],
     ["light", "moderate", "moderate", "heavy", "heavy", "extreme", "extreme"]),
    (rules.CLOUD, [24.0, 25.0, 50.0, 75.0, None],
     ["clear", "partly_cloudy", "mostly_cloudy", "overcast", "overcast"]),
    (rules.HUMIDITY, [29.0, 30.0, 60.0, 80.0, None],
     ["dry", "comfortable", "humid", "very_humid", "very_humid"]),
])
def test_bands(spark, bands, inputs, labels):
    assert each(spark, "double", inputs, lambda x: fn.band(x, bands)) == labels


def test_compass_wraps_at_north(spark):
    degrees = [0.0, 22.4, 22.5, 67.4, 67.5, 112.5, 157.5, 202.5, 247.5, 292.5, 337.4, 337.5,
               360.0, None]
    points = ["N", "N", "NE", "NE", "E", "SE", "S", "SW", "W", "NW", "NW", "N", "N", "VARIABLE"]
    assert each(spark, "double", degrees, fn.compass) == points


def test_hours(spark):
    hours = list(range(24))
    parts = each(spark, "int", hours, lambda h: fn.by_hour(h, rules.DAY_PARTS, "night"))
    assert parts == (["night"] * 6 + ["morning"] * 6 + ["afternoon"] * 6 + ["evening"] * 4
                     + ["night"] * 2)
    for ranges, inside in ((rules.RUSH_HOURS, {7, 8, 9, 17, 18, 19}),
                           (rules.LATE_NIGHT_HOURS, {23, 0, 1, 2, 3, 4}),
                           (rules.BUSINESS_HOURS, set(range(9, 18))),
                           (rules.DINING_HOURS, {12, 13, 14, 18, 19, 20, 21})):
        flags = each(spark, "int", hours, lambda h, r=ranges: fn.hour_in(h, r))
        assert {h for h in hours if flags[h]} == inside
    assert each(spark, "int", [None], lambda h: fn.hour_in(h, rules.RUSH_HOURS)) == [False]


def test_rounding_is_binary_and_away_from_zero(spark):
    assert each(spark, "double", [1.005, 0.125, -0.125, 2.675, None],
                lambda x: fn.round_half_away(x, 2)) == [1.0, 0.13, -0.13, 2.68, None]
    assert each(spark, "double", [0.25, -0.25, 32.45],
                lambda x: fn.round_half_away(x, 1)) == [0.3, -0.3, 32.5]
    assert each(spark, "double", [-25.0, 25.0, 24.9],
                lambda x: fn.round_half_away(x / 10) * 10) == [-30.0, 30.0, 20.0]


def test_whole_numbers_round_to_even(spark):
    assert each(spark, "double", [2.5, 3.5, -2.5, 2.4, None], fn.whole) == [2, 4, -2, 2, None]


def test_division_by_zero_is_null(spark):
    assert each(spark, "double", [0.0, 4.0], lambda x: fn.divide(F.lit(2), x)) == [None, 0.5]
    assert each(spark, "double", [0.0, 8.0], lambda x: fn.percent(F.lit(2), x)) == [None, 25.0]


def test_minutes_count_boundaries(spark):
    pairs = [
        ("2024-01-01 00:00:59", "2024-01-01 00:01:01", 1),
        ("2024-01-01 00:01:01", "2024-01-01 00:00:59", -1),
        ("2024-01-01 00:01:01", "2024-01-01 00:01:59", 0),
        ("2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
        ("2024-03-10 01:30:00", "2024-03-10 03:30:00", 120),  # a clock change elsewhere
        ("2024-01-01 00:00:00", None, None),
    ]
    df = spark.createDataFrame(
        [(i, datetime.fromisoformat(a), datetime.fromisoformat(b) if b else None)
         for i, (a, b, _) in enumerate(pairs)], "i int, a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.orderBy("i").select(fn.minute_diff(F.col("a"), F.col("b"))).collect()]
    assert got == [n for *_, n in pairs]


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moment = datetime(2024, 3, 10, 2, 45, 30, 250)  # skipped by clocks in that zone
        df = spark.createDataFrame([(moment,)], "x timestamp_ntz")
        row = df.select(fn.floor_hour(F.col("x")).alias("h"), fn.floor_month(F.col("x")).alias("m"),
                        fn.floor_day(F.col("x")).alias("d")).first()
        assert tuple(row) == (datetime(2024, 3, 10, 2), datetime(2024, 3, 1), datetime(2024, 3, 10))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar(spark):
    days = [date(2024, 2, 29), date(2024, 12, 31), date(2027, 1, 1), date(2027, 1, 8),
            date(2024, 3, 31), date(2024, 7, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = {r["date"]: r for r in df.select(
        *[c.alias(n) for n, c in fn.calendar(F.col("d")).items()]).collect()}
    assert rows[days[0]]["is_month_end"] and rows[days[0]]["day_of_year"] == 60
    assert rows[days[0]]["month_name_short"] == "Feb" and rows[days[0]]["day_name"] == "Thursday"
    last = rows[days[1]]
    assert last["is_year_end"] and last["is_quarter_end"] and last["week_of_year"] == 1
    first = rows[days[2]]
    assert first["is_year_start"] and first["is_quarter_start"] and first["week_of_year"] == 53
    assert rows[days[3]]["week_of_month"] == -51
    assert rows[days[4]]["is_quarter_end"] and rows[days[4]]["day_of_week"] == 0
    assert rows[days[4]]["is_weekend"] and not rows[days[4]]["is_weekday"]
    assert rows[days[5]]["is_quarter_start"] and not rows[days[5]]["is_year_start"]


def test_surrogate_key(spark):
    from hashlib import md5

    df = spark.createDataFrame([(datetime(2024, 1, 1, 5), None, 7)],
                               "t timestamp_ntz, s string, n bigint")
    expected = md5(b"2024-01-01 05:00:00-_dbt_utils_surrogate_key_null_-7").hexdigest()
    assert df.select(fn.surrogate_key("t", "s", "n")).first()[0] == expected


def test_labels(spark):
    assert each(spark, "string", ["yellow_taxi", "fhv"], fn.title_label) == ["Yellow Taxi", "Fhv"]
    assert each(spark, "bigint", [999, 1200, 2_345_678], fn.human_number) == [
        "999", "1.2K", "2.35M"]
    assert each(spark, "int", [3, None], fn.none_text) == ["3", "N/A"]


def test_days_of_a_series(spark):
    df = spark.createDataFrame([(date(2024, 2, 28), date(2024, 3, 1))], "a date, b date")
    days = df.select(F.explode(fn.series_of_days(F.col("a"), F.col("b")))).collect()
    assert [d[0] for d in days] == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
