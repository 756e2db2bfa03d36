"""Registered queries: name → (session, folder) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import landing
from checks.workspace import Workspace, workspace
from citytrips import functions as fn
from citytrips import fixtures, rules, schemas
from citytrips.operators import distinct, facts, gaps, merge, selection, staging
from citytrips.operators.dedup import keep_first
from citytrips.operators.dims import dim_time
from citytrips.plans import metrics, pipeline, quality, reports, rollups, semantic, suites
from citytrips.plans.semantic import query
from citytrips.sources import archives, columns, ingest, inventory, report, tables, weather, zones
from citytrips.sources import trips as trip_files
from citytrips.streaming import hourly as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUT = "1998-07-01"      # splits the data of the incremental queries
JANUARY = "2024-01-01"  # first day of the bike data
ALL_MONTHS = range(1, 13)


def registered(function: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(workspace(spark, folder))

    QUERIES[function.__name__] = run
    return function


def register(name: str, function: Callable[[Workspace], DataFrame]) -> None:
    function.__name__ = name
    registered(function)


def settle(df: DataFrame, *names: str) -> DataFrame:
    """Round double columns (all of them by default) to 8 digits.

    The last bits of a mean depend on the order of addition, which differs between engines
    and runs.
    """
    doubles = [f.name for f in df.schema.fields if f.dataType == T.DoubleType()]
    chosen = names or doubles
    return df.withColumns({n: fn.round_half_away(F.col(n), 8) for n in chosen})


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --- sources ----------------------------------------------------------------------------------


def _years(load: Callable, w: Workspace, folder: str) -> DataFrame:
    found = landing.months(w, folder)
    return columns.union_months([load(w.spark, folder, y, months) for y, months in found.items()])


@registered
def src_yellow_months(w: Workspace) -> DataFrame:
    return _years(trip_files.read_yellow, w, landing.yellow(w))


@registered
def src_fhv_months(w: Workspace) -> DataFrame:
    return _years(trip_files.read_fhv, w, landing.fhv(w))


@registered
def src_bike_csv(w: Workspace) -> DataFrame:
    return _years(trip_files.read_bike, w, landing.bike_csv(w))


@registered
def src_weather_json(w: Workspace) -> DataFrame:
    return weather.read_weather(w.spark, landing.weather_json(w))


@registered
def src_zones_csv(w: Workspace) -> DataFrame:
    return zones.read_zones(w.spark, landing.zones_csv(w))


@registered
def src_schema_evolution(w: Workspace) -> DataFrame:
    raw = w.raw("trips")
    split = ntz("2024-01-16")
    early = raw.filter(F.col("started_at") < split)
    late = raw.filter(F.col("started_at") >= split).withColumn(
        "battery", (fn.day_of_week(F.col("started_at")) * 10).cast("int"))
    return columns.union_months([early, late]).select("ride_id", "started_at", "battery")


@registered
def src_missing_months(w: Workspace) -> DataFrame:
    folder = landing.yellow(w)
    entries = []
    years = landing.months(w, folder)
    for year in range(min(years), max(years) + 2):
        entries += trip_files.load_yellow(w.spark, folder, year, ALL_MONTHS)[1]
    return report.report_frame(w.spark, entries).select("year", "month", "source", "status")


@registered
def src_ingest_report(w: Workspace) -> DataFrame:
    folder, root = landing.fhv(w), w.scratch("ingest")
    years = landing.months(w, folder)
    runs = [ingest.ingest(w.spark, folder, root, y, ALL_MONTHS, ["fhv"])
            for y in range(min(years), max(years) + 1)]
    return reduce(DataFrame.unionByName, runs).select("year", "month", "source", "status", "rows")


@registered
def src_file_inventory(w: Workspace) -> DataFrame:
    return inventory.file_inventory(w.spark, landing.yellow(w), "*.parquet")


@registered
def src_known_files(w: Workspace) -> DataFrame:
    """The inventory of files whose sizes follow from the trips of their months."""
    found = inventory.file_inventory(w.spark, landing.month_files(w), "*.txt", 20.0, 0.0012)
    return settle(found.drop("file_name", "last_modified"))


@registered
def src_bike_archives(w: Workspace) -> DataFrame:
    return archives.trips_of(archives.read_archives(w.spark, landing.bike_archives(w)))


@registered
def src_archive_report(w: Workspace) -> DataFrame:
    """Months of the archives, one of them cut short."""
    rows = archives.read_archives(w.spark, landing.bike_archives(w, spoilt=True))
    return archives.archive_report(w.spark, rows).select("year", "month", "source", "status", "rows")


@registered
def src_refused_weather(w: Workspace) -> DataFrame:
    """All months of the years with weather; documents without hours are refused."""
    folder, entries = landing.refused_weather(w), []
    for year in landing.months(w, folder):
        entries += weather.load_weather(w.spark, folder, year, ALL_MONTHS)[1]
    return report.report_frame(w.spark, entries).select("year", "month", "status", "error")


@registered
def src_staging_zone(w: Workspace) -> DataFrame:
    staged = tables.stage(w.raw("fhv_taxi"), w.scratch("stage"))
    return staged.groupBy("dispatching_base_num").agg(F.count(F.lit(1)).alias("trips"))


@registered
def src_table_sink(w: Workspace) -> DataFrame:
    path = w.scratch("sink")
    tables.write_table(ingest.with_month(w.raw("trips"), "trips"), path, tables.MONTH)
    written = tables.read_table(w.spark, path)
    return written.groupBy(tables.MONTH, "rideable_type").agg(F.count(F.lit(1)).alias("trips"))


@registered
def src_materialize_modes(w: Workspace) -> DataFrame:
    counts = w.raw("fhv_taxi").groupBy("d_olocation_id").agg(F.count(F.lit(1)).alias("trips"))
    parts = [
        tables.materialize(counts, mode, "fhv_by_zone", w.scratch("table")).withColumn(
            "mode", F.lit(mode))
        for mode in ("view", "table", "ephemeral")
    ]
    return reduce(DataFrame.unionByName, parts)


@registered
def src_export_csv(w: Workspace) -> DataFrame:
    path = w.scratch("export")
    tables.export_csv(reports.hourly_by_mode(w.fct), path)
    schema = "pickup_hour int, trip_type string, trips bigint, avg_duration double"
    return w.spark.read.schema(schema).option("header", "true").csv(path)


# --- merge and incremental refresh ---------------------------------------------------------------


def _fhv_batch(w: Workspace) -> DataFrame:
    """Trips from the cut on with another drop-off zone; part of them are in the target."""
    return w.raw("fhv_taxi").filter(F.col("pickup_datetime") >= ntz(CUT)).withColumn(
        "d_olocation_id", F.col("d_olocation_id") + 1000)


def _fhv_target(w: Workspace) -> DataFrame:
    return w.raw("fhv_taxi").filter(F.col("pickup_datetime") < ntz("1999-01-01"))


@registered
def inc_merge_by_key(w: Workspace) -> DataFrame:
    return merge.merge_by_key(_fhv_target(w), _fhv_batch(w), schemas.KEYS["fhv_taxi"])


@registered
def inc_merge_twice(w: Workspace) -> DataFrame:
    once = merge.merge_by_key(_fhv_target(w), _fhv_batch(w), schemas.KEYS["fhv_taxi"])
    return merge.merge_by_key(once, _fhv_batch(w), schemas.KEYS["fhv_taxi"])


@registered
def inc_merge_table(w: Workspace) -> DataFrame:
    """The same merge on a month-partitioned table on disk, run twice."""
    root = w.scratch("merge")
    ingest.merge_raw(w.spark, root, "fhv_taxi", _fhv_target(w))
    for _ in range(2):
        ingest.merge_raw(w.spark, root, "fhv_taxi", _fhv_batch(w))
    return ingest.raw_table(w.spark, root, "fhv_taxi").drop(tables.MONTH)


@registered
def inc_key_index(w: Workspace) -> DataFrame:
    """Rides that come again 45 days later: the key index finds the months of their older versions."""
    root, rides = w.scratch("index"), w.raw("trips")
    later = F.expr("interval 45 days")
    moved = rides.filter(F.substring("ride_id", 2, 20).cast("long") % 4 == 0).withColumns({
        "started_at": F.col("started_at") + later, "ended_at": F.col("ended_at") + later})
    ingest.merge_raw(w.spark, root, "trips", rides)
    for _ in range(2):
        ingest.merge_raw(w.spark, root, "trips", moved)
    return ingest.raw_table(w.spark, root, "trips").drop(tables.MONTH)


@registered
def inc_weather_changes(w: Workspace) -> DataFrame:
    """Weather that changes after the facts were built: a plain refresh repairs its hours."""
    store = _UpTo(w, w.scratch("changes"))
    store.warmer = True
    pipeline.refresh(store)
    store.warmer = False
    pipeline.refresh(store)
    return settle(store.table("fct_hourly_mobility"))


@registered
def inc_monthly_runs(w: Workspace) -> DataFrame:
    """Monthly runs on landed files: a month, the same again, a later one, an older one, which the
    high-water mark passes over, and a backfill of that one and another."""
    folder = landing.taxi_and_weather(w, 1996)
    store = pipeline.Store(w.spark, w.scratch("runs"), fixtures.MIN_PICKUP)
    rows, sources = [], ["taxi", "weather"]
    for step, month in (("first", 3), ("again", 3), ("later", 5), ("older", 2)):
        found = pipeline.run_month(store, folder, 1996, month, sources)
        rows.append((step, month, found.status, found.total_trips))
    summary = pipeline.backfill(store, folder, 1996, [2, 4], sources)
    loaded = store.table("fct_trips").groupBy("pickup_month").count()
    counts = {r["pickup_month"]: r["count"] for r in loaded.collect()}  # a row per month
    status = {m: kind for kind in ("successful", "failed") for m in summary[kind]}
    rows += [("backfill", m - 199600, status.get(m - 199600, "kept"), n) for m, n in counts.items()]
    return w.spark.createDataFrame(rows, "step string, month int, status string, trips bigint")


@registered
def inc_dedup_by_key(w: Workspace) -> DataFrame:
    items = w.spark.read.parquet(f"{w.folder}/lineitem.parquet")
    return keep_first(items, ["l_orderkey", "l_linenumber"],
                      [F.col("l_extendedprice").desc_nulls_last()])


def _loaded(w: Workspace) -> DataFrame:
    return w.fct.filter(F.col("pickup_datetime") < ntz(CUT))


@registered
def inc_new_trips(w: Workspace) -> DataFrame:
    new = merge.new_trips(w.trips(), _loaded(w))
    return new.select("trip_id", "trip_type", "pickup_datetime")


@registered
def inc_backfill_trips(w: Workspace) -> DataFrame:
    new = merge.new_trips(w.trips(), _loaded(w), start="1997-05-01")
    return new.select("trip_id", "trip_type", "pickup_datetime")


@registered
def inc_new_hours(w: Workspace) -> DataFrame:
    done = w.hourly.filter(F.col("hour_timestamp") < ntz("1998-07-01 12:00:00"))
    new = merge.new_hours(w.fct, done)
    return new.groupBy("trip_type").agg(
        F.count(F.lit(1)).alias("trips"), F.min("pickup_datetime").alias("first_trip"))


@registered
def inc_replace_by_key(w: Workspace) -> DataFrame:
    small = w.fct.select("trip_key", "trip_type", "pickup_datetime", "revenue")
    batch = small.filter(F.col("pickup_datetime") >= ntz(CUT)).withColumn(
        "revenue", F.col("revenue") + 1).drop("pickup_datetime")
    target = small.filter(F.col("pickup_datetime") < ntz("1999-01-01"))
    return merge.replace_by_key(target, batch, "trip_key")


@registered
def inc_sync_schema(w: Workspace) -> DataFrame:
    old = w.raw("fhv_taxi").select("dispatching_base_num", "pickup_datetime", "d_olocation_id")
    new = w.raw("fhv_taxi").select(
        "dispatching_base_num", "pickup_datetime", F.lit("app").alias("channel")).limit(0)
    return merge.sync_schema(old, new)


class _UpTo(pipeline.Store):
    """A store that has seen raw trips before a moment only."""

    def __init__(self, w: Workspace, root: str):
        super().__init__(w.spark, root, w.store.min_pickup)
        self.inner, self.before, self.warmer = w.store, None, False

    def raw(self, name: str) -> DataFrame:
        df = self.inner.raw(name)
        if self.warmer and name == "hourly_weather":
            return df.withColumn("temp", F.col("temp") + 20)
        if self.before is None or name == "hourly_weather":
            return df
        return df.filter(F.col(schemas.EVENT_TIME[name]) < ntz(self.before))


@registered
def inc_refresh_facts(w: Workspace) -> DataFrame:
    """Build with trips up to the cut, then add the rest incrementally."""
    store = _UpTo(w, w.scratch("refresh"))
    store.before = CUT
    pipeline.refresh(store)
    store.before = None
    pipeline.refresh(store)
    trips = store.table("fct_trips").groupBy("pickup_month", "trip_type").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("revenue").alias("revenue"))
    hours = store.table("fct_hourly_mobility").groupBy("pickup_month", "trip_type").agg(
        F.count(F.lit(1)).alias("hours"), F.sum("trip_count").alias("trips_in_hours"))
    return trips.join(hours, ["pickup_month", "trip_type"])


@registered
def inc_schema_change(w: Workspace) -> DataFrame:
    """A batch with a new column and without an old one: the months before it follow."""
    store = pipeline.Store(w.spark, w.scratch("schema"))
    base = w.fct.select("trip_key", "pickup_datetime", "trip_type", "revenue", tables.MONTH)
    tables.write_table(base.filter(F.col("pickup_datetime") < ntz(CUT)), store.path("trips"),
                       tables.MONTH)
    batch = base.filter(F.col("pickup_datetime") >= ntz(CUT)).drop("revenue").withColumn(
        "hour", F.hour("pickup_datetime"))
    pipeline.replace(store, "trips", batch, "trip_key", None, ())
    return store.table("trips").drop(tables.MONTH)


@registered
def inc_late_weather(w: Workspace) -> DataFrame:
    """Weather that changes after the facts were built: after a rebuild from the start, the hours
    still hold every trip once."""
    store = _UpTo(w, w.scratch("late"))
    store.warmer = False
    pipeline.refresh(store)
    store.warmer = True
    pipeline.refresh(store, start="1990-01-01")
    hours = store.table("fct_hourly_mobility").groupBy("trip_type").agg(
        F.sum("trip_count").alias("trips_in_hours"))
    trips = store.table("fct_trips").groupBy("trip_type").agg(F.count(F.lit(1)).alias("trips"))
    return trips.join(hours, "trip_type")


# --- staging ---------------------------------------------------------------------------------------

register("stg_yellow_taxi", lambda w: w.stg_yellow())
register("stg_fhv_taxi", lambda w: w.stg_fhv())
register("stg_bike_trips", lambda w: w.stg_bike())
register("stg_hourly_weather", lambda w: w.stg_weather())
register("trips_unioned", lambda w: w.trips())
register("stg_date_floor", lambda w: staging.stg_yellow(w.raw("yellow_taxi"), "1999-03-01").select(
    "trip_id", "pickup_datetime", "total_amount"))
register("filter_trips", lambda w: staging.filter_trips(
    w.fct, "1996-02-10", "1999-11-20", rules.YELLOW).select("trip_key", "pickup_datetime"))
register("date_bounds", lambda w: staging.date_bounds(w.fct))


# --- dimensions ------------------------------------------------------------------------------------

register("dim_date", lambda w: w.dim_date())
register("dim_weather", lambda w: w.dim_weather())
register("dim_location", lambda w: w.dim_location())


@registered
def dim_time_of_trips(w: Workspace) -> DataFrame:
    """The hour dimension with the trips of each hour."""
    trips = w.trips().groupBy(F.hour("pickup_datetime").alias("hour")).agg(
        F.count(F.lit(1)).alias("trips"))
    return dim_time(w.spark).join(trips, "hour", "left")


@registered
def time_spine_filled(w: Workspace) -> DataFrame:
    """The day spine over the range of the data with the trips of each day."""
    return w.spine().join(
        reports.daily_totals(w.fct).select("date", "trip_count"),
        F.col("date_day") == F.col("date"), "left",
    ).select("date_day", F.coalesce("trip_count", F.lit(0).cast("long")).alias("trip_count"))


# --- facts and joins ----------------------------------------------------------------------------------


@registered
def fct_trips(w: Workspace) -> DataFrame:
    return facts.fct_trips(w.trips(), w.weather)


@registered
def fct_hourly_mobility(w: Workspace) -> DataFrame:
    return settle(facts.fct_hourly(facts.fct_trips(w.trips(), w.weather)))


register("fct_trips_table", lambda w: w.fct)
register("fct_hourly_table", lambda w: settle(w.hourly))


@registered
def trip_time_flags(w: Workspace) -> DataFrame:
    return facts.with_time_flags(w.trips()).select(
        "trip_id", "trip_duration_minutes", "avg_speed_mph", "pickup_hour", "day_of_week",
        "is_weekend", "day_part", "is_rush_hour", "is_business_hours", "is_late_night")


@registered
def trip_keys(w: Workspace) -> DataFrame:
    return facts.with_keys(w.trips()).select(
        "trip_id", "trip_key", "date_key", "time_key", "pickup_location_key",
        "dropoff_location_key")


@registered
def join_weather_left(w: Workspace) -> DataFrame:
    return facts.join_weather(w.trips(), w.weather).select(
        "trip_id", "pickup_datetime", "timestamp", "temp", "temp_category")


@registered
def join_star(w: Workspace) -> DataFrame:
    return reports.hourly_profile(w.fct, w.dates, w.hours)


@registered
def join_missing_dates(w: Workspace) -> DataFrame:
    return gaps.missing_dates(w.fct)


@registered
def join_missing_dates_of_month(w: Workspace) -> DataFrame:
    return gaps.missing_dates(w.raw("trips"), "started_at", "2024-01-01", "2024-02-15")


@registered
def join_date_difference(w: Workspace) -> DataFrame:
    """Expected days minus present days as sets."""
    present = gaps.days_present(w.fct)
    return gaps.expected_days(present).subtract(present).select("expected_date")


@registered
def join_orphan_keys(w: Workspace) -> DataFrame:
    """Pickup locations of trips that are no zone, with their trips."""
    parent = w.zones.select(F.col("location_key").alias("pickup_location_key"))
    return quality.orphans(w.fct, parent, "pickup_location_key")


# --- scalar functions ---------------------------------------------------------------------------------


@registered
def fn_numbers(w: Workspace) -> DataFrame:
    items = w.spark.read.parquet(f"{w.folder}/lineitem.parquet")
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        fn.round_half_away(price / 7, 2).alias("two_digits"),
        fn.round_half_away(price / 1000, 1).alias("one_digit"),
        (fn.round_half_away(price / 10) * 10).alias("bucket"),
        fn.whole(quantity / 2).alias("half_even"),
        fn.c_to_f(quantity - 25).alias("fahrenheit"),
        fn.divide(price, F.col("l_linenumber") - 1).alias("quotient"),
        fn.percent(quantity, price, 4).alias("pct"),
    )


@registered
def fn_calendar(w: Workspace) -> DataFrame:
    orders = w.spark.read.parquet(f"{w.folder}/orders.parquet")
    day = F.to_date("o_orderdate")
    parts = fn.calendar(day)
    return orders.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@registered
def fn_time(w: Workspace) -> DataFrame:
    ts = F.col("ts")
    later = ts + F.make_dt_interval(secs=F.col("value") * 10)
    events = w.spark.read.parquet(f"{w.folder}/events.parquet")
    return events.select(
        "event_id", fn.floor_hour(ts).alias("hour"), fn.floor_month(ts).alias("month"),
        fn.floor_day(ts).alias("day"), fn.month_key(ts).alias("month_key"),
        fn.iso_date(ts).alias("date_key"), fn.day_of_week(ts).alias("dow"),
        fn.minute_diff(ts, fn.floor_hour(later)).alias("minutes_back"),
        fn.minute_diff(fn.floor_hour(ts), ts).alias("minutes_in_hour"),
    )


@registered
def fn_labels(w: Workspace) -> DataFrame:
    modes = reports.mode_comparison(w.fct)
    return modes.select(
        "trip_type", fn.title_label(F.col("trip_type")).alias("label"),
        fn.human_number(F.col("total_trips")).alias("trips"),
        fn.none_text(F.col("avg_revenue").cast("int")).alias("revenue"),
        fn.none_text(F.col("avg_distance").cast("int"), "-").alias("distance"),
    )


@registered
def fn_surrogate_key(w: Workspace) -> DataFrame:
    orders = w.spark.read.parquet(f"{w.folder}/orders.parquet")
    return orders.select(
        "o_orderkey",
        fn.surrogate_key("o_orderkey", "o_orderdate", "o_orderpriority").alias("key"),
        fn.surrogate_key(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")),
                         F.col("o_orderkey") % 2 == 0).alias("key_with_null"),
    )


# --- semantic layer ---------------------------------------------------------------------------------


def _metrics(names, *group_by: str, **options):
    return lambda w: query(metrics.TRIPS, w.semantic_tables(), list(names), group_by, **options)


register("sem_core_metrics", lambda w: settle(
    _metrics(metrics.CORE, "trip_type")(w), "avg_trip_speed_mph"))
register("sem_mode_share_metrics", _metrics(metrics.MODE_SHARE, "day_part"))
register("sem_time_pattern_metrics", _metrics(metrics.TIME_PATTERNS, "metric_time", grain="month"))
register("sem_weather_impact_metrics", _metrics(metrics.WEATHER_IMPACT, "trip_type"))
register("sem_joined_dimensions", _metrics(
    ("total_trips", "avg_fare", "median_trip_duration_minutes"), "date__is_weekend",
    "pickup_location__borough", "time__time_period"))
register("sem_filtered_query", _metrics(
    ("total_trips", "avg_trip_duration_minutes", "rush_hour_trip_rate"), "trip_type", "day_part",
    where="is_adverse_weather and date__quarter = 2", joined=("date__quarter",)))
register("sem_ordered_top", lambda w: query(
    metrics.TRIPS, w.semantic_tables(), ["total_trips", "total_revenue"], ["pickup_datetime"],
    order_by=[F.desc("total_trips"), "pickup_datetime"], limit=15))
register("sem_filled_periods", _metrics(
    ("total_trips", "citibike_trips"), "metric_time", grain="week", fill=True))


@registered
def sem_trip_measures(w: Workspace) -> DataFrame:
    names = [m.name for m in metrics.TRIPS.measures]
    return settle(query(metrics.TRIPS, w.semantic_tables(), names, ["trip_type", "temp_category"]))


@registered
def sem_hourly_measures(w: Workspace) -> DataFrame:
    names = [m.name for m in metrics.HOURLY.measures]
    return settle(query(metrics.HOURLY, w.semantic_tables(), names, ["trip_type", "day_part"]))


@registered
def sem_hourly_dimensions(w: Workspace) -> DataFrame:
    groups = [d.name for d in metrics.HOURLY.dimensions if d.name != "hour_timestamp"]
    return query(metrics.HOURLY, w.semantic_tables(), ["total_trips", "rush_hour_trips"],
                 ["metric_time", *groups], grain="year")


@registered
def sem_trip_dimensions(w: Workspace) -> DataFrame:
    groups = [d.name for d in metrics.TRIPS.dimensions if d.name != "pickup_datetime"]
    return query(metrics.TRIPS, w.semantic_tables(), ["total_trips", "total_passengers"],
                 ["metric_time", *groups], grain="quarter")


@registered
def sem_basic_metrics(w: Workspace) -> DataFrame:
    return query(metrics.TRIPS_BASIC, w.semantic_tables(), list(metrics.TRIPS_BASIC.metrics),
                 ["is_weekend", "trip_type"])


@registered
def sem_metric_values(w: Workspace) -> DataFrame:
    """Every metric of the catalogue with its value over all trips."""
    parts = []
    for model in (metrics.TRIPS, metrics.TRIPS_BASIC):
        wide = query(model, w.semantic_tables(), list(model.metrics))
        cells = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
                 for n in model.metrics]
        parts.append(wide.select(F.lit(model.name).alias("model"), F.inline(F.array(*cells))))
    values = reduce(DataFrame.unionByName, parts)
    names = semantic.catalog(w.spark, *metrics.MODELS)
    return settle(names.join(values, ["model", "metric"], "left"), "value")


def _navigated(w: Workspace, expected, *arguments, **options) -> DataFrame:
    """A query over kept states; it must not fall back to the fact."""
    tables = w.semantic_tables()
    assert rollups.choose(metrics.TRIPS, tables, w.rollups, *arguments, **options) == expected
    return rollups.navigate(metrics.TRIPS, tables, w.rollups, *arguments, **options)


@registered
def sem_states_all_metrics(w: Workspace) -> DataFrame:
    """All metrics but the median by mode and quarter, from monthly states."""
    names = [n for n in metrics.TRIPS.metrics if not n.startswith("median")]
    return settle(_navigated(w, rollups.TRIP_MONTHS, names, ["metric_time", "trip_type"], "quarter"),
                  "avg_trip_speed_mph")


@registered
def sem_states_joined(w: Workspace) -> DataFrame:
    """Measures by weekday and part of the day of joined tables in rain, from hourly states."""
    names = ["total_trips", "total_revenue", "max_trip_duration", "avg_precipitation"]
    return settle(_navigated(
        w, rollups.TRIP_HOURS, names, ["date__is_weekend", "time__time_period"],
        where="precipitation_type = 'rain' and date__week_of_year > 4", joined=["date__week_of_year"]))


@registered
def sem_states_daily(w: Workspace) -> DataFrame:
    """Daily revenue and passengers of weekends, from daily states."""
    return settle(_navigated(
        w, rollups.MODE_DAYS, ["total_revenue", "total_passengers", "weekend_trips"],
        ["metric_time"], where="is_weekend"))


@registered
def agg_exact_medians(w: Workspace) -> DataFrame:
    """Medians over all trips and by mode, each by searching the range with the middle."""
    values = {n: F.col(n) for n in ("trip_duration_minutes", "trip_distance", "avg_speed_mph", "revenue")}
    whole = selection.exact_medians(w.fct, [], values).withColumn("trip_type", F.lit("all"))
    return settle(selection.exact_medians(w.fct, ["trip_type"], values).unionByName(whole))


def _states(w: Workspace) -> DataFrame:
    """Written states of months and modes, made from two parts that share trips."""
    early = w.fct.filter(F.col("pickup_datetime") < ntz(CUT))
    late = w.fct.filter(F.col("pickup_datetime") >= ntz("1996-01-01"))
    both = distinct.merge_states(distinct.distinct_states(early), distinct.distinct_states(late))
    return tables.stage(both, w.scratch("states"))


@registered
def agg_distinct_states(w: Workspace) -> DataFrame:
    """Different days and hours of every month, added up over the modes."""
    return distinct.distinct_counts(_states(w), ["pickup_month"])


@registered
def agg_distinct_range(w: Workspace) -> DataFrame:
    """Different days and hours of each mode and of all, in a range within months."""
    states, span = _states(w), ("1996-03-10", "1998-07-20")
    whole = distinct.distinct_counts(states, (), *span).withColumn("trip_type", F.lit("all"))
    return distinct.distinct_counts(states, ["trip_type"], *span).unionByName(whole)


# --- data quality -------------------------------------------------------------------------------------


def _checked_tables(w: Workspace, declared) -> dict[str, DataFrame]:
    """The tables that rules are declared for, and their parents. Rules of staged tables alone need
    no facts, so none are built for them."""
    parents = {r.values[0] for rules_of in declared.values() for r in rules_of if r.kind == "relationship"}
    staged = {"stg_yellow": w.stg_yellow, "stg_fhv": w.stg_fhv, "stg_bike": w.stg_bike,
              "stg_weather": w.stg_weather}
    return {name: staged[name]() if name in staged else w.table(name)
            for name in {*declared, *parents}}


def _suites(w: Workspace, declared) -> DataFrame:
    found = _checked_tables(w, declared)
    results = [
        quality.run_suite(found[name], rules_of, found).withColumn("table_name", F.lit(name))
        for name, rules_of in declared.items()
    ]
    return reduce(DataFrame.unionByName, results)


register("dq_declared_tests", lambda w: _suites(w, suites.DECLARED))
register("dq_expectations", lambda w: _suites(w, suites.EXPECTATIONS))
register("dq_business_rules", lambda w: _suites(w, suites.BUSINESS))
register("dq_failing_rows", lambda w: quality.failing_rows(
    w.fct, quality.not_null("dropoff_datetime")[0]).select("trip_key", "pickup_datetime"))
register("dq_duplicates", lambda w: quality.duplicates(
    w.raw("yellow_taxi").withColumn("start", fn.floor_day(F.col("tpep_pickup_datetime"))), "start"))


@registered
def dq_checked_writes(w: Workspace) -> DataFrame:
    """The staged tables written anew, their rules counted by the tasks that write."""
    declared, results = {name: suites.DECLARED[name] for name in suites.STAGED}, []
    found = _checked_tables(w, declared)
    for name in suites.STAGED:
        _, result = quality.write_checked(found[name], w.scratch(name), declared[name], found)
        results.append(result.withColumn("table_name", F.lit(name)))
    return reduce(DataFrame.unionByName, results)


@registered
def dq_stored_failures(w: Workspace) -> DataFrame:
    path = w.scratch("failures")
    quality.run_suite(w.fct, suites.DECLARED["fct_trips"],
                      {"dim_date": w.dates, "dim_time": w.hours}, store_failures=path)
    kept = w.spark.read.parquet(f"{path}/rows").filter("rule = 'not_null_dropoff_datetime'")
    return kept.groupBy("trip_type").agg(F.count(F.lit(1)).alias("rows"))


register("dq_weather_coverage", lambda w: quality.weather_coverage(w.fct))
register("dq_month_completeness", lambda w: quality.month_completeness(w.fct))
register("dq_month_completeness_small", lambda w: quality.month_completeness(w.fct, 700))
register("dq_date_gaps", lambda w: quality.date_gaps(w.fct))
register("dq_gap_ranges", lambda w: quality.gap_ranges(w.fct))
register("dq_month_edges", lambda w: gaps.month_edge_gaps(w.raw("fhv_taxi"), "pickup_datetime"))
register("dq_missing_estimate", lambda w: gaps.missing_estimate(
    w.raw("fhv_taxi"), "pickup_datetime"))
register("dq_row_counts", lambda w: quality.row_count_between(w.fct, 1000, 50_000))
register("dq_key_health", lambda w: quality.key_health(w.fct))
register("dq_key_health_raw", lambda w: quality.key_health(w.raw("fhv_taxi"), "p_ulocation_id"))
register("dq_freshness", lambda w: quality.freshness(w.fct))
register("dq_retention", lambda w: quality.retention(
    [w.raw("yellow_taxi"), w.raw("fhv_taxi"), w.raw("trips")], w.fct))
register("dq_coverage_status", lambda w: quality.coverage_status(w.fct))
register("dq_month_status", lambda w: settle(quality.month_status(w.fct, 500)))
register("dq_low_volume_days", lambda w: quality.low_volume_days(w.fct, 25))
register("dq_recommendations", lambda w: settle(quality.recommendations(w.fct, 500)))


# --- reports ------------------------------------------------------------------------------------------

FCT_REPORTS = (
    "key_metrics", "daily_by_mode", "hourly_by_mode", "weather_rows", "temperature_buckets",
    "rain_levels", "mode_comparison", "weekend_split", "data_summary", "coverage_span",
    "monthly_by_mode", "daily_totals", "hourly_coverage", "month_mode_pivot",
    "calendar_heatmap", "weather_coverage_by_month", "mode_distribution", "temperature_impact",
    "precipitation_impact", "rain_change", "mode_share", "mode_share_of_total", "rush_split",
    "rush_share", "dataset_summary", "core_by_mode", "wet_weather_top", "coverage_by_mode",
    "coverage_total", "trips_per_month",
)
for _name in FCT_REPORTS:
    register(f"rpt_{_name}", lambda w, f=getattr(reports, _name): f(w.fct))
register("rpt_filtered_metrics", lambda w: reports.key_metrics(
    staging.filter_trips(w.fct, "1997-01-15", "2000-06-30", rules.FHV)))
register("rpt_bike_heatmap", lambda w: reports.calendar_heatmap(w.fct, "citibike_trips"))
register("rpt_hourly_pattern", lambda w: reports.hourly_pattern(w.fct, w.hours))
register("rpt_peak_hours", lambda w: reports.peak_hours(w.fct, w.hours))
register("rpt_daily_trend", lambda w: reports.daily_trend(w.fct, w.dates))
register("rpt_mean_daily_trips", lambda w: reports.mean_daily_trips(w.fct, w.dates))
register("rpt_weekday_pattern", lambda w: reports.weekday_pattern(w.fct, w.dates))
register("rpt_weekend_difference", lambda w: reports.weekend_difference(w.fct, w.dates))
register("rpt_weather_correlation", lambda w: settle(reports.weather_correlation(w.fct)))
register("rpt_top_zones", lambda w: reports.top_zones(w.fct, w.zones))
register("rpt_period_by_rush", lambda w: reports.period_by_rush(w.fct, w.dates, w.hours))
register("rpt_day_part_share", lambda w: reports.day_part_share(w.fct, w.hours))
register("rpt_month_validation", lambda w: reports.month_validation(w.fct, 1998, 6))
register("rpt_raw_weather_ranges", lambda w: reports.raw_weather_ranges(
    w.raw("yellow_taxi"), w.raw("hourly_weather")))
register("rpt_mode_hour_weather", lambda w: reports.mode_hour_weather(
    w.raw("yellow_taxi"), w.raw("fhv_taxi"), w.raw("trips"), w.raw("hourly_weather")))
register("rpt_trips_by_weather", lambda w: reports.trips_by_weather(
    w.raw("fhv_taxi"), "pickup_datetime", w.raw("hourly_weather")))
register("rpt_bike_month_coverage", lambda w: reports.bike_month_coverage(w.raw("trips")))
register("rpt_bike_daily_counts", lambda w: reports.bike_daily_counts(
    w.raw("trips"), JANUARY, "2024-02-01"))
register("rpt_sample_rows", lambda w: reports.sample_rows(w.fct, 100))
register("sem_filled_total", lambda w: query(
    metrics.TRIPS, w.semantic_tables(), ["total_trips"], ["metric_time"], grain="week", fill=True
).agg(F.sum("total_trips").alias("filled"), F.lit(w.fct.count()).cast("long").alias("total")))


# --- streams ------------------------------------------------------------------------------------------


@registered
def str_merge_bike(w: Workspace) -> DataFrame:
    """Bike trips arriving as files in three batches, each file also a second time."""
    folder, root = w.scratch("arriving"), w.scratch("streamed")
    raw = w.raw("trips").repartition(3)
    raw.write.parquet(folder)
    w.spark.read.parquet(folder).write.mode("append").parquet(folder)
    stream.merge_stream(w.spark, folder, root, "trips", w.scratch("checkpoint"),
                        files_per_batch=3).awaitTermination()
    return ingest.raw_table(w.spark, root, "trips").drop(tables.MONTH)


@registered
def str_bike_archives(w: Workspace) -> DataFrame:
    """Archives merged by a stream that is started again, the second time with a cut one."""
    root, checkpoint = w.scratch("archived"), w.scratch("checkpoint")
    for spoilt in (False, True):
        archives.merge_archives(w.spark, landing.bike_archives(w, spoilt), root,
                                checkpoint).awaitTermination()
    return ingest.raw_table(w.spark, root, "trips").drop(tables.MONTH)


@registered
def str_hourly_medians(w: Workspace) -> DataFrame:
    """Three batches, each a restart: half of the last hour before the first cut comes with the
    second batch; trips before 1996 come again with the third, behind the watermark."""
    folder, path, checkpoint = w.scratch("arriving"), w.scratch("medians"), w.scratch("checkpoint")
    trips = w.trips().select("trip_type", "pickup_datetime", "revenue", "trip_distance")
    at = F.col("pickup_datetime")
    late = (at >= ntz("1996-12-31 23:00:00")) & (at < ntz("1997-01-01")) & (F.minute(at) % 2 == 1)
    batches = (
        trips.filter((at < ntz("1997-01-01")) & ~late),
        trips.filter(late | ((at >= ntz("1997-01-01")) & (at < ntz(CUT)))),
        trips.filter((at >= ntz(CUT)) | (at < ntz("1996-01-01"))),
    )
    for batch in batches:
        batch.write.mode("append").parquet(folder)
        stream.median_stream(w.spark, folder, path, checkpoint, batch.schema,
                             ["revenue", "trip_distance"]).awaitTermination()
    return tables.read_table(w.spark, path).drop(tables.MONTH)


@registered
def str_hourly_counts(w: Workspace) -> DataFrame:
    folder, path = w.scratch("arriving"), w.scratch("hourly")
    trips = w.trips().select("trip_type", "pickup_datetime", "revenue", "trip_distance")
    trips.write.parquet(folder)
    stream.hourly_stream(w.spark, folder, path, w.scratch("checkpoint"),
                         w.spark.read.parquet(folder).schema).awaitTermination()
    return tables.read_table(w.spark, path).drop(tables.MONTH)
