"""Report queries over the facts and dimensions.

Reports that need a dimension first aggregate the fact on the dimension's key and join the
small result, so no join sees single trips. Averages of such two-step reports are kept as
sums and counts until the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citytrips import rules
from citytrips.functions import (
    band, divide, floor_hour, floor_month, percent, round_half_away,
)
from citytrips.operators.gaps import month_coverage

def _rows() -> Column:
    return F.count(F.lit(1))


def _rank_of(column: str, values: Sequence[str]) -> Column:
    """Position of a value in a fixed order, unknown values last."""
    result = None
    for position, value in enumerate(values):
        result = (F if result is None else result).when(F.col(column) == value, position)
    return result.otherwise(len(values))


def _has_weather() -> Column:
    return F.count("temp_category")


# --- analytics dashboard --------------------------------------------------------------------


def key_metrics(fct: DataFrame) -> DataFrame:
    """Totals over all trips. Modes are summed up first, which makes counting them trivial."""
    by_mode = fct.groupBy("trip_type").agg(
        _rows().alias("n"), F.sum("trip_distance").alias("miles"),
        F.count("trip_distance").alias("n_miles"), F.sum("revenue").alias("revenue"),
        F.sum("trip_duration_minutes").alias("minutes"),
        F.count("trip_duration_minutes").alias("n_minutes"),
    )
    return by_mode.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_trips"),
        divide(F.sum("miles"), F.sum("n_miles")).alias("avg_distance"),
        F.sum("revenue").alias("total_revenue"),
        divide(F.sum("minutes"), F.sum("n_minutes")).alias("avg_duration"),
        F.count("trip_type").alias("num_modes"),
    )


def daily_by_mode(fct: DataFrame) -> DataFrame:
    return fct.groupBy(F.to_date("pickup_datetime").alias("date"), "trip_type").agg(
        _rows().alias("trips"), F.avg("trip_distance").alias("avg_distance"),
    ).orderBy("date", "trip_type")


def hourly_by_mode(fct: DataFrame) -> DataFrame:
    return fct.groupBy("pickup_hour", "trip_type").agg(
        _rows().alias("trips"), F.avg("trip_duration_minutes").alias("avg_duration"),
    ).orderBy("pickup_hour", "trip_type")


def weather_rows(fct: DataFrame) -> DataFrame:
    """How many trips have a temperature."""
    return fct.agg(F.count("temperature_fahrenheit").alias("count"))


def temperature_buckets(fct: DataFrame, width: int = 10) -> DataFrame:
    """Trips by rounded temperature in °F."""
    bucket = round_half_away(F.col("temperature_fahrenheit") / width) * width
    return fct.filter("temperature_fahrenheit is not null").groupBy(
        bucket.alias("temp_bucket"), "trip_type"
    ).agg(
        _rows().alias("trips"), F.avg("trip_distance").alias("avg_distance"),
    ).orderBy("temp_bucket", "trip_type")


def rain_levels(fct: DataFrame) -> DataFrame:
    amount = F.col("precipitation")
    level = F.when(amount == 0, rules.RAIN_LEVEL_DRY).otherwise(band(amount, rules.RAIN_LEVELS))
    return fct.filter("precipitation is not null").groupBy(
        level.alias("rain_level"), "trip_type"
    ).agg(_rows().alias("trips")).orderBy("rain_level", "trip_type")


def mode_comparison(fct: DataFrame) -> DataFrame:
    return fct.groupBy("trip_type").agg(
        _rows().alias("total_trips"), F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
        F.sum("revenue").alias("total_revenue"), F.avg("revenue").alias("avg_revenue"),
    ).orderBy(F.desc("total_trips"))


def weekend_split(fct: DataFrame) -> DataFrame:
    return fct.groupBy("is_weekend", "trip_type").agg(
        _rows().alias("trips"), F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    ).withColumn(
        "day_category", F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    ).orderBy("is_weekend", "trip_type")


# --- data overview --------------------------------------------------------------------------


def _per_day_and_mode(fct: DataFrame) -> DataFrame:
    """Counts per day and mode: at most a few rows per calendar day.

    The overview reports count distinct days, months and modes. Counting them on this
    result needs no distinct aggregation over the fact.
    """
    return fct.groupBy(F.to_date("pickup_datetime").alias("day"), "trip_type").agg(
        _rows().alias("n"), _has_weather().alias("n_weather"),
        F.min("pickup_datetime").alias("first_trip"), F.max("pickup_datetime").alias("last_trip"),
    )


def data_summary(fct: DataFrame) -> DataFrame:
    """Range, days, months, modes and weather coverage, and the share of days with data."""
    days = _per_day_and_mode(fct)
    trips, covered = F.sum("n"), F.sum("n_weather")
    return days.agg(
        F.min("day").alias("earliest_date"),
        F.max("day").alias("latest_date"),
        trips.alias("total_trips"),
        F.count_distinct("day").alias("days_with_data"),
        F.count_distinct(F.trunc("day", "month")).alias("months_with_data"),
        F.count_distinct("trip_type").alias("trip_types"),
        covered.alias("trips_with_weather"),
        percent(covered, trips, 4).alias("weather_coverage_pct"),
    )


def coverage_span(fct: DataFrame) -> DataFrame:
    """Days spanned by the data and the share of them that has any."""
    summary = data_summary(fct)
    span = F.datediff("latest_date", "earliest_date") + 1
    return summary.select(
        "earliest_date", "latest_date", "days_with_data", span.alias("date_range_days"),
        percent(F.col("days_with_data"), span).alias("day_coverage_pct"),
    )


def monthly_by_mode(fct: DataFrame) -> DataFrame:
    trips, covered = F.sum("n"), F.sum("n_weather")
    return _per_day_and_mode(fct).groupBy(floor_month(F.col("day")).alias("month"), "trip_type").agg(
        trips.alias("trip_count"),
        _rows().alias("days_in_month"),
        covered.alias("trips_with_weather"),
        percent(covered, trips, 2).alias("weather_coverage_pct"),
        F.min("first_trip").alias("first_trip"),
        F.max("last_trip").alias("last_trip"),
    ).orderBy("month", "trip_type")


def daily_totals(fct: DataFrame) -> DataFrame:
    """Trips per day, in all and by mode."""
    mode = F.col("trip_type")
    return fct.groupBy(F.to_date("pickup_datetime").alias("date")).agg(
        _rows().alias("trip_count"),
        *[F.count(F.when(mode == m, 1)).alias(f"{m}_trips") for m in rules.MODES],
        _has_weather().alias("trips_with_weather"),
    ).orderBy("date")


def hourly_coverage(fct: DataFrame) -> DataFrame:
    by_mode = fct.groupBy(floor_hour(F.col("pickup_datetime")).alias("hour"), "trip_type").agg(
        _rows().alias("n"))
    return by_mode.groupBy("hour").agg(
        F.sum("n").alias("trip_count"), F.count("trip_type").alias("trip_types_present"),
    ).orderBy("hour")


def month_mode_pivot(fct: DataFrame) -> DataFrame:
    """Months × modes with the month total; 0 where a mode has no trips."""
    table = fct.groupBy(floor_month(F.col("pickup_datetime")).alias("month")).pivot(
        "trip_type", list(rules.MODES)
    ).agg(_rows()).fillna(0, list(rules.MODES))
    total = sum((F.col(m) for m in rules.MODES[1:]), F.col(rules.MODES[0]))
    return table.withColumns({
        "month_total": total, "month_str": F.date_format("month", "yyyy-MM"),
    }).orderBy("month")


def calendar_heatmap(fct: DataFrame, metric: str = "trip_count") -> DataFrame:
    """Weekday (0 = Monday) × week of month for every month, 0 where a day has no trips."""
    days = daily_totals(fct)
    day = F.col("date")
    week = F.floor((F.dayofmonth(day) - 1) / 7).cast("int") + 1
    grid = days.select(
        F.year(day).alias("year"), F.month(day).alias("month"), F.weekday(day).alias("weekday"),
        week.alias("week"), F.col(metric).alias("v"),
    ).groupBy("year", "month", "weekday").pivot("week", [1, 2, 3, 4, 5]).agg(F.sum("v"))
    names = [f"week_{i}" for i in range(1, 6)]
    return grid.toDF("year", "month", "weekday", *names).fillna(0, names).orderBy(
        "year", "month", "weekday")


def weather_coverage_by_month(fct: DataFrame) -> DataFrame:
    covered, trips = F.sum("trips_with_weather"), F.sum("trip_count")
    return monthly_by_mode(fct).groupBy("month").agg(
        covered.alias("trips_with_weather"), trips.alias("trip_count"),
        percent(covered, trips).alias("coverage_pct"),
    ).orderBy("month")


def mode_distribution(fct: DataFrame) -> DataFrame:
    return monthly_by_mode(fct).groupBy("trip_type").agg(F.sum("trip_count").alias("trip_count"))


# --- exploration ----------------------------------------------------------------------------


def hourly_pattern(fct: DataFrame, hours: DataFrame) -> DataFrame:
    """Trips and mean duration by hour of the day, through the hour dimension."""
    small = fct.groupBy("time_key", "trip_type").agg(
        _rows().alias("n"), F.sum("trip_duration_minutes").alias("minutes"),
        F.count("trip_duration_minutes").alias("n_minutes"),
    )
    return small.join(hours.select("time_key", "hour"), "time_key").groupBy("hour", "trip_type").agg(
        F.sum("n").alias("trips"),
        divide(F.sum("minutes"), F.sum("n_minutes")).alias("avg_duration"),
    ).orderBy("hour", "trip_type")


def peak_hours(fct: DataFrame, hours: DataFrame) -> DataFrame:
    """Busiest hour of each mode; of equal hours the earliest."""
    best = F.max_by(F.struct("hour", "trips"), F.struct("trips", -F.col("hour")))
    return hourly_pattern(fct, hours).groupBy("trip_type").agg(best.alias("b")).select(
        "trip_type", F.col("b.hour").alias("peak_hour"), F.col("b.trips").alias("trips"))


def daily_trend(fct: DataFrame, dates: DataFrame) -> DataFrame:
    small = fct.groupBy("date_key", "trip_type").agg(
        _rows().alias("trips"), F.count(F.when(F.col("is_rush_hour"), 1)).alias("rush_hour_trips"))
    return small.join(dates.select("date_key", "date", "is_weekend"), "date_key").groupBy(
        "date", "is_weekend", "trip_type"
    ).agg(
        F.sum("trips").alias("trips"), F.sum("rush_hour_trips").alias("rush_hour_trips"),
    ).orderBy("date", "trip_type")


def mean_daily_trips(fct: DataFrame, dates: DataFrame) -> DataFrame:
    return daily_trend(fct, dates).groupBy("trip_type").agg(
        F.avg("trips").alias("avg_daily_trips")).orderBy("trip_type")


def weekday_pattern(fct: DataFrame, dates: DataFrame) -> DataFrame:
    small = fct.groupBy("date_key", "trip_type").agg(
        _rows().alias("n"), F.sum("trip_distance").alias("miles"),
        F.count("trip_distance").alias("n_miles"),
    )
    return small.join(dates.select("date_key", "day_name", "day_of_week"), "date_key").groupBy(
        "day_name", "day_of_week", "trip_type"
    ).agg(
        F.sum("n").alias("trips"),
        divide(F.sum("miles"), F.sum("n_miles")).alias("avg_distance"),
    ).orderBy("day_of_week", "trip_type")


def weekend_difference(fct: DataFrame, dates: DataFrame) -> DataFrame:
    """How much the mean weekend day of the week differs from the mean weekday, in percent."""
    weekend = F.col("day_of_week").isin(0, 6)
    means = weekday_pattern(fct, dates).groupBy("trip_type").agg(
        F.avg(F.when(~weekend, F.col("trips"))).alias("weekday_avg"),
        F.avg(F.when(weekend, F.col("trips"))).alias("weekend_avg"),
    )
    difference = percent(F.col("weekend_avg") - F.col("weekday_avg"), F.col("weekday_avg"))
    return means.withColumn("pct_diff", difference).orderBy("trip_type")


def _impact(fct: DataFrame, category: str, order: Sequence[str]) -> DataFrame:
    return fct.filter(F.col(category).isNotNull()).groupBy(category, "trip_type").agg(
        _rows().alias("trips"), F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    ).orderBy(_rank_of(category, order), "trip_type")


def temperature_impact(fct: DataFrame) -> DataFrame:
    return _impact(fct, "temp_category", rules.TEMPERATURE.labels)


def precipitation_impact(fct: DataFrame) -> DataFrame:
    return _impact(fct, "precipitation_type", rules.PRECIPITATION_TYPES)


def rain_change(fct: DataFrame) -> DataFrame:
    """Trips in rain against trips in dry hours, by mode, in percent."""
    kind = F.col("precipitation_type")
    counts = fct.filter(kind.isNotNull()).groupBy("trip_type").agg(
        F.count(F.when(kind == "none", 1)).alias("dry_trips"),
        F.count(F.when(kind == "rain", 1)).alias("rain_trips"),
    )
    return counts.withColumn(
        "pct_change", percent(F.col("rain_trips") - F.col("dry_trips"), F.col("dry_trips"))
    ).orderBy("trip_type")


def weather_correlation(fct: DataFrame) -> DataFrame:
    """Pearson correlations of four measurements and the trips under equal conditions.

    Trips are counted per combination of measurements first, so the correlations run over
    weather conditions. The matrix comes as rows (variable_a, variable_b, correlation).
    """
    variables = ("temp", "precipitation", "wind_speed", "humidity", "trip_count")
    conditions = fct.filter("temperature_celsius is not null").groupBy(
        F.col("temperature_celsius").alias("temp"), "precipitation", "wind_speed", "humidity"
    ).agg(_rows().alias("trip_count"))
    pairs = [(a, b) for i, a in enumerate(variables) for b in variables[i:]]
    wide = conditions.agg(*[
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}:{b}")
        for a, b in pairs
    ])

    def cell(a: str, b: str) -> Column:
        name = f"{a}:{b}" if (a, b) in pairs else f"{b}:{a}"
        return F.struct(F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"),
                        F.col(f"`{name}`").alias("correlation"))

    return wide.select(F.inline(F.array(*[cell(a, b) for a in variables for b in variables])))


def mode_share(fct: DataFrame) -> DataFrame:
    """Share of each mode in all trips; the window runs over one row per mode."""
    modes = fct.groupBy("trip_type").agg(
        _rows().alias("trips"), F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    )
    total = F.sum("trips").over(Window.partitionBy())
    return modes.withColumn("pct_share", percent(F.col("trips"), total, 2)).orderBy(
        F.desc("trips"))


def mode_share_of_total(fct: DataFrame, total: int | None = None) -> DataFrame:
    """The same share against a given total, by default that of the modes counted."""
    modes = fct.groupBy("trip_type").agg(_rows().alias("trips"))
    whole = F.sum("trips").over(Window.partitionBy()) if total is None else F.lit(total)
    return modes.withColumn("mode_share_pct", percent(F.col("trips"), whole, 2)).orderBy(
        F.desc("mode_share_pct"))


def top_zones(fct: DataFrame, zones: DataFrame, limit: int = 20) -> DataFrame:
    """Zones with most taxi pickups."""
    small = fct.filter(F.col("trip_type").isin(rules.YELLOW, rules.FHV)).groupBy(
        "pickup_location_key", "trip_type").agg(_rows().alias("n"))
    named = small.join(
        zones.select(F.col("location_key").alias("pickup_location_key"), "zone_name", "borough"),
        "pickup_location_key",
    )
    return named.groupBy("zone_name", "borough", "trip_type").agg(
        F.sum("n").alias("pickups")
    ).orderBy(F.desc("pickups"), "zone_name", "borough", "trip_type").limit(limit)


def hourly_profile(fct: DataFrame, dates: DataFrame, hours: DataFrame) -> DataFrame:
    """Trips by hour, weekend against weekday."""
    small = fct.groupBy("date_key", "time_key", "trip_type").agg(_rows().alias("n"))
    dated = small.join(dates.select("date_key", "is_weekend"), "date_key").groupBy(
        "is_weekend", "time_key", "trip_type").agg(F.sum("n").alias("n"))
    period = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return dated.join(hours.select("time_key", "hour"), "time_key").groupBy(
        period.alias("period"), "hour", "trip_type"
    ).agg(F.sum("n").alias("trips")).orderBy("period", "hour", "trip_type")


def rush_split(fct: DataFrame) -> DataFrame:
    period = F.when(F.col("is_rush_hour"), "Rush Hour").otherwise("Non-Rush")
    return fct.groupBy(period.alias("period"), "trip_type").agg(
        _rows().alias("trips"), F.avg("trip_duration_minutes").alias("avg_duration"),
        F.avg("trip_distance").alias("avg_distance"),
    ).orderBy("trip_type", "period")


def rush_share(fct: DataFrame) -> DataFrame:
    """Share of trips in rush hours."""
    rush = F.count(F.when(F.col("is_rush_hour"), 1))
    return fct.agg(rush.alias("rush_trips"), _rows().alias("total_trips"),
                   percent(rush, _rows()).alias("rush_pct"))


def dataset_summary(fct: DataFrame) -> DataFrame:
    """Headline numbers. The fact has one row per trip key, which the quality rules check, so trips
    are counted as rows; sums per day are combined before days are counted."""
    days = fct.groupBy("date_key").agg(
        _rows().alias("trips"), F.count("temp_category").alias("covered"),
        F.sum("trip_distance").alias("d"), F.count("trip_distance").alias("dn"),
        F.sum("trip_duration_minutes").alias("m"), F.count("trip_duration_minutes").alias("mn"),
    )
    covered, trips = F.sum("covered"), F.sum("trips")
    return days.agg(
        F.coalesce(trips, F.lit(0)).alias("total_trips"),
        F.count("date_key").alias("total_days"),
        round_half_away(divide(F.sum("d"), F.sum("dn")), 2).alias("avg_distance"),
        round_half_away(divide(F.sum("m"), F.sum("mn")), 2).alias("avg_duration"),
        F.coalesce(covered, F.lit(0)).alias("trips_with_weather"),
        percent(covered, trips, 2).alias("weather_coverage_pct"),
    )


def core_by_mode(fct: DataFrame) -> DataFrame:
    return fct.groupBy("trip_type").agg(
        _rows().alias("total_trips"),
        round_half_away(F.avg("trip_duration_minutes"), 2).alias("avg_duration_minutes"),
        round_half_away(F.avg("trip_distance"), 2).alias("avg_distance_miles"),
        round_half_away(F.avg("avg_speed_mph"), 2).alias("avg_speed_mph"),
    ).orderBy(F.desc("total_trips"))


def period_by_rush(fct: DataFrame, dates: DataFrame, hours: DataFrame) -> DataFrame:
    small = fct.groupBy("date_key", "time_key").agg(_rows().alias("n"))
    joined = small.join(dates.select("date_key", "is_weekend"), "date_key").join(
        hours.select("time_key", "is_rush_hour"), "time_key")
    return joined.groupBy("is_weekend", "is_rush_hour").agg(F.sum("n").alias("trips")).select(
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("period"),
        F.when(F.col("is_rush_hour"), "Rush Hour").otherwise("Non-Rush Hour").alias("time_type"),
        "trips",
    ).orderBy("period", "time_type")


def wet_weather_top(fct: DataFrame, limit: int = 10) -> DataFrame:
    return fct.filter(F.col("precipitation_type") != "none").groupBy(
        "precipitation_type", "trip_type"
    ).agg(
        _rows().alias("trips"),
        round_half_away(F.avg("trip_duration_minutes"), 2).alias("avg_duration"),
    ).orderBy(F.desc("trips"), "precipitation_type", "trip_type").limit(limit)


def day_part_share(fct: DataFrame, hours: DataFrame) -> DataFrame:
    small = fct.groupBy("time_key").agg(_rows().alias("n"))
    parts = small.join(hours.select("time_key", "day_part"), "time_key").groupBy("day_part").agg(
        F.sum("n").alias("trips"))
    total = F.sum("trips").over(Window.partitionBy())
    return parts.withColumn("pct_of_total", percent(F.col("trips"), total, 2)).orderBy(
        F.desc("trips"))


# --- operations -----------------------------------------------------------------------------


def month_validation(fct: DataFrame, year: int, month: int) -> DataFrame:
    """Trips of one month by mode; the month is a partition of the fact."""
    if "pickup_month" in fct.columns:
        picked = fct.filter(F.col("pickup_month") == year * 100 + month)
    else:
        pickup = F.col("pickup_datetime")
        picked = fct.filter((F.year(pickup) == year) & (F.month(pickup) == month))
    return picked.groupBy("trip_type").agg(
        _rows().alias("trip_count"), F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    )


def raw_weather_ranges(yellow: DataFrame, weather: DataFrame) -> DataFrame:
    """Raw taxi trips per hour by temperature range and rain.

    Trips are counted per hour before the join, so each weather row meets one row per hour.
    """
    hours = yellow.groupBy(floor_hour(F.col("tpep_pickup_datetime")).alias("hour")).agg(
        _rows().alias("n"))
    joined = hours.join(
        weather.select(floor_hour(F.col("timestamp")).alias("hour"), "temp", "precipitation"),
        "hour",
    )
    return joined.groupBy(
        band(F.col("temp"), rules.TEMPERATURE_RANGES).alias("temp_range"),
        F.when(F.col("precipitation") > 0, "Rainy").otherwise("Dry").alias("precipitation_status"),
    ).agg(
        F.count_distinct("hour").alias("hours"),
        divide(F.sum("n"), F.count_distinct("hour")).alias("avg_trips_per_hour"),
    ).orderBy(F.desc("avg_trips_per_hour"))


def mode_hour_weather(yellow: DataFrame, fhv: DataFrame, bike: DataFrame,
                      weather: DataFrame) -> DataFrame:
    """Raw trips per hour and mode with the weather of the hour."""

    def hourly(df: DataFrame, ts: str, name: str) -> DataFrame:
        return df.groupBy(floor_hour(F.col(ts)).alias("hour")).agg(
            _rows().alias("trips")).select("hour", F.lit(name).alias("mode"), "trips")

    counts = (
        hourly(yellow, "tpep_pickup_datetime", "Yellow Taxi")
        .unionByName(hourly(fhv, "pickup_datetime", "FHV"))
        .unionByName(hourly(bike, "started_at", "CitiBike"))
    )
    return counts.join(
        weather.select(floor_hour(F.col("timestamp")).alias("hour"), "temp", "precipitation"),
        "hour",
    ).orderBy("hour", F.desc("trips"))


def trips_by_weather(trips: DataFrame, ts: str, weather: DataFrame) -> DataFrame:
    """Raw trips of one mode by the presence of weather for their hour.

    Trips are counted per hour first, so the join sees hours, not trips.
    """
    hours = trips.groupBy(floor_hour(F.col(ts)).alias("hour")).agg(_rows().alias("trips"))
    known = weather.groupBy(floor_hour(F.col("timestamp")).alias("hour")).agg(
        _rows().alias("rows"), F.count("temp").alias("temps"))
    joined = hours.join(known, "hour", "left")
    # an hour with several rows of weather counts its trips as often as a join of trips would
    total = F.coalesce(F.sum(F.col("trips") * F.coalesce("rows", F.lit(1))), F.lit(0))
    covered = F.coalesce(F.sum(F.col("trips") * F.coalesce("temps", F.lit(0))), F.lit(0))
    return joined.agg(total.alias("total_trips"), covered.alias("trips_with_weather"),
                      percent(covered, total).alias("coverage_pct"))


def coverage_by_mode(fct: DataFrame) -> DataFrame:
    covered = F.count("temperature_fahrenheit")
    return fct.groupBy("trip_type").agg(
        _rows().alias("total_trips"), covered.alias("trips_with_weather"),
        percent(covered, _rows(), 2).alias("pct_coverage"),
    )


def coverage_total(fct: DataFrame) -> DataFrame:
    covered = _has_weather()
    return fct.agg(_rows().alias("total_trips"), covered.alias("with_weather"),
                   percent(covered, _rows(), 6).alias("coverage_pct"))


def bike_month_coverage(raw: DataFrame, since: str | None = None) -> DataFrame:
    return month_coverage(raw, "started_at", since)


def bike_daily_counts(raw: DataFrame, start: str, before: str) -> DataFrame:
    """Bike trips per day from start up to, not including, before."""
    ts = F.col("started_at")
    picked = raw.filter((ts >= F.lit(start).cast("timestamp_ntz"))
                        & (ts < F.lit(before).cast("timestamp_ntz")))
    return picked.groupBy(F.to_date(ts).alias("date")).agg(_rows().alias("trips")).orderBy("date")


def trips_per_month(fct: DataFrame) -> DataFrame:
    return fct.groupBy(floor_month(F.col("pickup_datetime")).alias("month")).agg(
        _rows().alias("trips")).orderBy("month")


def sample_rows(fct: DataFrame, n: int) -> DataFrame:
    """The first n rows by trip key, the same ones in every run."""
    return fct.orderBy("trip_key").limit(n)
