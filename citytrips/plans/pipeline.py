"""From raw tables to dimensions and facts: full build, incremental refresh, backfill."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytrips import rules, schemas
from citytrips.operators.dims import dim_date, dim_location, dim_time, dim_weather, time_spine
from citytrips.functions import floor_hour, month_key
from citytrips.operators.facts import fct_hourly, fct_trips, with_weather
from citytrips.operators.gaps import days_present
from citytrips.operators.merge import latest, new_hours, new_trips, sync_schema
from citytrips.operators.staging import (
    stg_bike, stg_fhv, stg_weather, stg_yellow, trips_unioned,
)
from citytrips.plans.quality import duplicates
from citytrips.session import free_shuffles
from citytrips.sources.ingest import DEFAULT_SOURCES, ingest, raw_table
from citytrips.sources.months import month_bounds
from citytrips.sources.tables import (
    MONTH, ensure_index, exists, merge_into, months_of, months_present, overwrite_months, read_table,
    stage, write_table,
)


#: Ranges of months that trips are taken in, about, and trips that are not worth a range of their own.
RANGES, RANGE_TRIPS = 8, 2_000_000


def count_by_month(df: DataFrame) -> dict:
    """Rows of each month; one small row per calendar month reaches the driver."""
    return dict(df.groupBy(MONTH).count().collect())


def month_ranges(counts: Mapping[int | None, int]) -> list[tuple[int | None, int | None]]:
    """First and last months of consecutive ranges with about as many trips each; a month is never cut.

    What is shuffled, sorted and written at a time, and so the disk it takes beside the tables, is
    that of one range, a fixed share of all trips. The first range is open at its start and the last one
    at its end, so every trip lies in one of them, whatever was counted.
    """
    goal = max(RANGE_TRIPS, sum(counts.values()) / RANGES)
    months = sorted(m for m in counts if m is not None)
    ranges, first, held = [], None, counts.get(None, 0)
    for month, following in zip(months, months[1:]):
        held += counts[month]
        if held + counts[following] / 2 > goal:
            ranges.append((first, following - 1))  # trips of a month between that was not counted lie before
            first, held = following, 0
    return [*ranges, (first, None)]


def within(month: Column, first: int | None, last: int | None) -> Column:
    """Whether a month lies between two, both included; a missing one lies in a range that is open at its start."""
    if first is None:
        return F.lit(True) if last is None else F.coalesce(month <= last, F.lit(True))
    return month >= first if last is None else month.between(first, last)


def picked_up_within(first: int | None, last: int | None) -> Column:
    """The same for the months of pickups, by bounds that are cheap to compare and reach a scan."""
    pickup = F.col("pickup_datetime")

    def start(month: int) -> Column:
        return F.make_date(F.lit(month // 100), F.lit(month % 100), F.lit(1)).cast("timestamp_ntz")

    after = F.lit(True) if first is None else pickup >= start(first)
    if last is None:
        return after
    before = pickup < start(last + 1 if last % 100 < 12 else last + 89)
    return before | pickup.isNull() if first is None else after & before


def in_ranges(fct: DataFrame) -> list[DataFrame]:
    """A table of months, or part of it, cut into ranges of its months."""
    return [fct.filter(within(F.col(MONTH), *r)) for r in month_ranges(count_by_month(fct))]


class Store:
    """Tables under one root: ``raw/<table>`` and ``core/<table>``."""

    def __init__(self, spark: SparkSession, root: str, min_pickup: str = rules.MIN_PICKUP):
        self.spark, self.root, self.min_pickup = spark, root.rstrip("/"), min_pickup

    def path(self, name: str) -> str:
        return f"{self.root}/core/{name}"

    def raw(self, name: str) -> DataFrame | None:
        """Declared columns of a raw table, None where it has not been loaded."""
        return raw_table(self.spark, self.root, name, declared=True)

    def table(self, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        return read_table(self.spark, self.path(name), schema)

    def trips(self, from_month: int | None = None, to_month: int | None = None) -> DataFrame:
        """Union of the staged modes that have been loaded, between two months (yyyymm).

        Without a first month, trips without a month are among them.
        """

        def raw(name: str) -> DataFrame | None:
            df = self.raw(name)
            if df is None or MONTH not in df.columns:
                return df
            return df.filter(within(F.col(MONTH), from_month, to_month))

        yellow, fhv, bike = raw("yellow_taxi"), raw("fhv_taxi"), raw("trips")
        return trips_unioned(
            yellow=None if yellow is None else stg_yellow(yellow, self.min_pickup, wide=False),
            fhv=None if fhv is None else stg_fhv(fhv, self.min_pickup, wide=False),
            bike=None if bike is None else stg_bike(bike),
        )

    def trips_by_month(self, from_month: int | None = None, to_month: int | None = None) -> dict:
        """Number of raw trips of each month between two, before staging leaves any out."""
        months = []
        for name in ("yellow_taxi", "fhv_taxi", "trips"):
            df = self.raw(name)
            if df is not None:
                month = F.col(MONTH) if MONTH in df.columns else month_key(F.col(schemas.EVENT_TIME[name]))
                months.append(df.select(month.alias(MONTH)).filter(within(F.col(MONTH), from_month, to_month)))
        return count_by_month(reduce(DataFrame.unionByName, months)) if months else {}

    def weather(self) -> DataFrame:
        raw = self.raw("hourly_weather")
        if raw is None:
            raise FileNotFoundError("hourly_weather has not been loaded")
        return dim_weather(stg_weather(raw))


class DuplicateHours(ValueError):
    """The weather has several rows for one hour, which would multiply trips."""


def write_weather(store: Store) -> DataFrame:
    """Write the weather dimension; one row per hour is a precondition of the trip fact."""
    write_table(store.weather(), store.path("dim_weather"))
    weather = store.table("dim_weather")
    if not duplicates(weather, "weather_key").isEmpty():
        raise DuplicateHours("hourly_weather has several rows for an hour")
    return weather


DIGESTS = "weather_digests"


def weather_digests(weather: DataFrame) -> DataFrame:
    """One digest per hour over all the columns of the weather dimension."""
    # a hash skips nulls, so where they are is hashed along
    return weather.select(floor_hour(F.col("timestamp")).alias("hour"), F.xxhash64(
        *weather.columns, *[F.col(c).isNull() for c in weather.columns]).alias("digest"))


def changed_hours(weather: DataFrame, known: DataFrame | None) -> DataFrame:
    """Hours whose weather differs from the digests of an earlier load, is new, or is gone."""
    now = weather_digests(weather)
    if known is None:
        return now.select("hour")
    before = known.withColumnRenamed("digest", "_before")
    differs = ~F.col("digest").eqNullSafe(F.col("_before"))
    return now.join(before, "hour", "full").filter(differs).select("hour")


def repair_weather(store: Store, weather: DataFrame) -> None:
    """Bring trips and hours of the facts up to the present weather, only where it changed.

    The digests of the weather the facts were last brought up to are kept beside them and
    written last, so an interrupted repair is done again. Months without a trip in a changed hour
    are not written. The other months are written anew as they are read, trip by trip and range by
    range: no key is compared and no trip is shuffled.
    """
    spark = store.spark
    changed = stage(changed_hours(weather, store.table(DIGESTS)), f"{store.root}/staging/hours")
    months = {r[0] for r in changed.select(month_key(F.col("hour"))).distinct().collect()}
    present = months & months_present(spark, store.path("fct_trips"))
    if present:
        few = changed.count() <= FEW_HOURS

        def stale(months: set) -> DataFrame:
            fct = store.table("fct_trips").filter(F.col(MONTH).isin(sorted(months)))
            hours = F.broadcast(changed) if few else changed
            return fct.withColumn("hour", floor_hour(F.col("pickup_datetime"))).join(
                hours, "hour", "left_semi").drop("hour")

        touched = months_of(stale(present))
        fct = store.table("fct_trips").filter(F.col(MONTH).isin(sorted(touched)))
        for first, last in month_ranges(count_by_month(fct)) if touched else ():
            months = {m for m in touched if (first is None or m >= first) and (last is None or m <= last)}
            fct = store.table("fct_trips").filter(F.col(MONTH).isin(sorted(months)))
            overwrite_months(with_weather(fct, weather, changed, few), store.path("fct_trips"),
                             TRIP_ORDER, dealt=few)
            hours = stage(fct_hourly(stale(months)), f"{store.root}/staging/repaired_hours")
            merge_into(spark, store.path("fct_hourly_mobility"), hours, ["hour_timestamp"], None, HOUR_ORDER)
            free_shuffles(spark)
    if not changed.isEmpty() or store.table(DIGESTS) is None:
        write_table(weather_digests(weather), store.path(DIGESTS))


def write_dimensions(store: Store, trips: DataFrame, zones: DataFrame | None = None,
                     renew: bool = True) -> None:
    """Write the calendar, hour, zone and spine dimensions.

    Without ``renew`` the calendar keeps its days and is extended to those of the trips, which
    may be a batch, and dimensions that do not depend on data are left alone.
    """
    # The days present are few, so the calendar bounds need one narrow pass over the trips.
    days = days_present(trips).select(F.col("actual_date").alias("pickup_datetime"))
    known = None if renew else store.table("dim_date")
    if known is not None:
        day = F.col("date_key").cast("date")
        known = known.agg(F.min(day).alias("first"), F.max(day).alias("last"))
        days = days.union(known.select(F.explode(F.array("first", "last"))))
    write_table(dim_date(days), store.path("dim_date"))
    fixed = {"dim_time": dim_time, "time_spine": time_spine}
    for name, build_fixed in fixed.items():
        if renew or not exists(store.spark, f"{store.path(name)}/_SUCCESS"):
            write_table(build_fixed(store.spark), store.path(name))
    if zones is not None:
        write_table(dim_location(zones), store.path("dim_location"))


TRIP_ORDER, HOUR_ORDER = ("pickup_datetime",), ("hour_timestamp",)
#: A ride id says nothing about its month, so a ride may come again in another one.
MOVABLE = ("trip_type", rules.BIKE)


#: Hours of weather that are broadcast to the trips, some 20 years.
FEW_HOURS = 200_000


def dealt_by_month(trips: DataFrame) -> DataFrame:
    """Trips rebalanced by month, and sorted, before they get keys, flags and weather: a quarter
    of the columns is shuffled and sorted, and ids that are hexadecimal digests travel as bytes."""
    return _months_in_order(trips).drop(MONTH)


def _months_in_order(trips: DataFrame) -> DataFrame:
    """The same with the month each trip was dealt by."""
    trip_id = F.col("trip_id")
    packed = F.unhex(trip_id)
    same = F.coalesce(F.lower(F.hex(packed)) == trip_id, F.lit(False))
    narrow = trips.withColumns({
        "trip_id": F.when(~same, trip_id), "_packed": F.when(same, packed),
        MONTH: month_key(F.col("pickup_datetime"))})
    return _in_order(narrow.hint("rebalance", F.col(MONTH))).withColumn(
        "trip_id", F.coalesce("trip_id", F.lower(F.hex("_packed")))).drop("_packed")


def _in_order(narrow: DataFrame) -> DataFrame:
    """Narrow trips in the order the fact is written in.

    The optimizer drops a sort below a join, though a broadcast join keeps its order. A filter that
    depends on the partition, and lets every row pass, holds it in place; the write of the whole
    fact then finds its rows in order and need not sort them at five times the width.
    """
    return narrow.sortWithinPartitions(MONTH, *TRIP_ORDER).filter(F.spark_partition_id() >= 0)


def dealt_trips(trips: DataFrame, weather: DataFrame) -> tuple[DataFrame, bool]:
    """The trip fact of the trips, and whether its rows lie by month.

    The narrow trips are rebalanced by month, sorted and then joined to the broadcast weather. Where
    the weather has too many hours for that, the join shuffles, so its rows lie anywhere after it.
    """
    if weather.count() <= FEW_HOURS:
        return fct_trips(_months_in_order(trips), F.broadcast(weather)), True
    return fct_trips(trips, weather), False


def landed_trips(store: Store, batch: DataFrame, weather: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The trip fact of a batch that is landed while narrow; where its rows lie by month, also the same
    in the order it is written in.

    The batch is read several times, mostly for its keys or months alone, and sorted for the write
    only; keys, flags and weather are added as it is read.
    """
    path = f"{store.root}/staging/fct_trips"
    if weather.count() <= FEW_HOURS:
        narrow = stage(_months_in_order(batch), path)
        return tuple(fct_trips(trips, F.broadcast(weather)) for trips in (narrow, _in_order(narrow)))
    return stage(fct_trips(batch, weather), path), None


def trips_in_ranges(store: Store, from_month: int | None = None, to_month: int | None = None) -> list[DataFrame]:
    """The staged trips between two months, cut into ranges of months.

    The raw tables are pruned to the months of a range where they have them; the month of the pickup,
    which is part of the keys that copies are found by, cuts the others before they are shuffled.
    """
    parts = []
    for first, last in month_ranges(store.trips_by_month(from_month, to_month)):
        trips = store.trips(from_month if first is None else first, to_month if last is None else last)
        parts.append(trips.filter(picked_up_within(first, last)))
    return parts


def write_trips(store: Store, weather: DataFrame) -> None:
    """Write the trip fact by month, each month by few tasks, and range by range."""
    (fct, dealt), *more = [dealt_trips(trips, weather) for trips in trips_in_ranges(store)]
    write_table(fct, store.path("fct_trips"), MONTH, TRIP_ORDER, dealt=dealt, more=[part for part, _ in more])


def write_hours(store: Store, fct: DataFrame) -> None:
    """Write the hourly fact of all trips, range by range."""
    hours, *more = [fct_hourly(part) for part in in_ranges(fct)]
    write_table(hours, store.path("fct_hourly_mobility"), MONTH, HOUR_ORDER, more=more)


def build(store: Store, zones: DataFrame | None = None) -> None:
    """Full refresh of all dimensions and facts."""
    weather = write_weather(store)
    write_trips(store, weather)
    free_shuffles(store.spark)
    fct = store.table("fct_trips")
    # All read the fact only; run together, one fills the cluster while the others wind up.
    with ThreadPoolExecutor(4) as pool:
        index = pool.submit(ensure_index, store.spark, store.path("fct_trips"), ["trip_key"], MOVABLE)
        digests = pool.submit(write_table, weather_digests(weather), store.path(DIGESTS))
        hourly = pool.submit(write_hours, store, fct)
        dimensions = pool.submit(write_dimensions, store, fct, zones)
        hourly.result(), dimensions.result(), index.result(), digests.result()
    free_shuffles(store.spark)


def replace(store: Store, name: str, batch: DataFrame, key: str,
            movable: tuple[str, ...] | None, order_by: Sequence[str], dealt: bool = False,
            landed: bool = False, ordered: DataFrame | None = None) -> DataFrame:
    """Delete+insert a batch by key; only the months concerned are rewritten. Returns the batch.

    The batch is landed first, unless it says it is: it is read several times, and its footers tell
    whether its keys are few enough to be broadcast to the target. The rows of a batch ``dealt`` by month
    lie so in the landed files and are not shuffled again; ``ordered`` has them in the order of the
    write. A batch with other columns, or other types, than the table changes the table: all its
    months follow.
    """
    path = store.path(name)
    rows = batch if landed else stage(batch, f"{store.root}/staging/{name}")
    before = store.table(name)
    if rows.isEmpty():
        return rows
    merge_into(store.spark, path, rows, [key], movable, order_by, dealt, ordered)
    if before is not None and dict(before.dtypes) != dict(rows.dtypes):
        whole = read_table(store.spark, path, evolving=True)
        write_table(sync_schema(whole, rows), path, MONTH, order_by)
    return rows


def _recent(store: Store, name: str) -> DataFrame | None:
    """The last month of a table, found by the names of its folders."""
    table = store.table(name)
    months = [m for m in months_present(store.spark, store.path(name)) if m is not None]
    return table if table is None or not months else table.filter(F.col(MONTH) == max(months))


def refresh(store: Store, full_refresh: bool = False, start: str | None = None,
            zones: DataFrame | None = None, end: str | None = None) -> None:
    """Bring the facts up to date.

    By default trips later than the latest loaded pickup are added, with ``start`` all trips
    from that date on (up to, not including, ``end``) are rebuilt, and a full refresh rebuilds
    everything. Missing or empty facts always mean a full refresh. Weather that has changed
    since the last refresh is brought into the hours it belongs to, whenever they were loaded.
    Many trips are rebuilt range by range of months, the earliest first, so after a failure the
    latest pickup still has no missing trip before it.
    """
    fct = None if full_refresh else store.table("fct_trips")
    if fct is None or fct.isEmpty():
        build(store, zones)
        return
    weather = write_weather(store)
    repair_weather(store, weather)
    recent = _recent(store, "fct_trips")
    # The mark prunes the raw tables to months; the strict comparison follows on the rows.
    since = latest(recent, "pickup_datetime") if start is None else date.fromisoformat(start[:10])
    last = None if end is None else date.fromisoformat(end[:10])
    batches = [new_trips(trips, recent, start) for trips in trips_in_ranges(
        store, since.year * 100 + since.month, None if last is None else last.year * 100 + last.month)]
    days = []
    for batch in batches:
        if end is not None:
            batch = batch.filter(F.col("pickup_datetime") < F.lit(end).cast("timestamp_ntz"))
        rows, ordered = landed_trips(store, batch, weather)
        free_shuffles(store.spark)
        landed = replace(store, "fct_trips", rows, "trip_key", MOVABLE, TRIP_ORDER, ordered is not None, True, ordered)
        day = F.to_date("pickup_datetime")
        days += [(d,) for d in landed.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()]
        free_shuffles(store.spark)
    bounds = store.spark.createDataFrame(days, "day string").select(
        F.col("day").cast("date").cast("timestamp_ntz").alias("pickup_datetime"))
    fct = store.table("fct_trips", store.table("fct_trips").schema)
    hours = new_hours(fct, _recent(store, "fct_hourly_mobility"), start)
    if end is not None:
        hours = hours.filter(F.col("pickup_datetime") < F.lit(end).cast("timestamp_ntz"))

    def replace_hours() -> None:
        # Whole hours are replaced: weather that arrived late changes the key of an hour.
        for part in in_ranges(hours):
            replace(store, "fct_hourly_mobility", fct_hourly(part), "hour_timestamp", None, HOUR_ORDER)
            free_shuffles(store.spark)

    with ThreadPoolExecutor(2) as pool:
        hourly = pool.submit(replace_hours)
        dimensions = pool.submit(write_dimensions, store, bounds, zones, renew=False)
        hourly.result(), dimensions.result()
    free_shuffles(store.spark)


class MonthResult(NamedTuple):
    year: int
    month: int
    status: str
    total_trips: int
    report: DataFrame
    by_mode: DataFrame


def run_month(store: Store, landing: str, year: int, month: int,
              sources: Iterable[str] | str = DEFAULT_SOURCES, full_refresh: bool = False,
              start: str | None = None, zones: DataFrame | None = None) -> MonthResult:
    """Load one month, refresh the facts and validate the month.

    The status is ``error_no_data`` when the fact has no trip of the month, which happens
    when a month older than the loaded ones is refreshed incrementally.
    """
    from citytrips.plans.reports import month_validation

    report = ingest(store.spark, landing, store.root, year, [month], sources)
    refresh(store, full_refresh, start, zones)
    by_mode = month_validation(store.table("fct_trips"), year, month)
    total = by_mode.agg(F.coalesce(F.sum("trip_count"), F.lit(0))).first()[0]
    status = "validated" if total else "error_no_data"
    return MonthResult(year, month, status, total, report, by_mode)


def backfill(store: Store, landing: str, year: int, months: Sequence[int],
             sources: Iterable[str] | str = DEFAULT_SOURCES, continue_on_error: bool = False,
             full_refresh: bool = False, zones: DataFrame | None = None,
             run: Callable[..., MonthResult] | None = None) -> dict[str, object]:
    """Load several months, then rebuild the facts of just these months, once.

    The high-water mark would pass over months older than the loaded ones; a start date
    does not. Stops at the first month that fails or has no trips unless told to continue.
    With ``run`` every month is loaded and refreshed by that function, one after the other.
    """
    if run is None:
        return _backfill_together(store, landing, year, months, sources, continue_on_error,
                                  full_refresh, zones)
    successful, failed, errors = [], [], {}
    for month in months:
        try:
            result = run(store, landing, year, month, sources, full_refresh=full_refresh,
                         start=f"{year}-{month:02d}-01", zones=zones)
            problem = None if result.status == "validated" else result.status
        except Exception as error:  # noqa: BLE001 - a failed month is part of the summary
            problem = f"{type(error).__name__}: {error}"
        if problem is None:
            successful.append(month)
            continue
        failed.append(month)
        errors[month] = problem
        if not continue_on_error:
            break
    return {
        "successful": successful, "failed": failed, "errors": errors, "total": len(months),
    }


def _backfill_together(store: Store, landing: str, year: int, months: Sequence[int],
                       sources: Iterable[str] | str, continue_on_error: bool,
                       full_refresh: bool, zones: DataFrame | None) -> dict[str, object]:
    loaded, errors = [], {}
    for month in months:
        try:
            report = ingest(store.spark, landing, store.root, year, [month], sources).collect()
            trips = [r for r in report if r["source"] != "hourly_weather"]
            problem = None if not trips or any(r["rows"] for r in trips) else "error_no_data"
        except Exception as error:  # noqa: BLE001 - a failed month is part of the summary
            problem = f"{type(error).__name__}: {error}"
        if problem is None:
            loaded.append(month)
            continue
        errors[month] = problem
        if not continue_on_error:
            break
    ranges: list[list[int]] = []  # of consecutive months
    for month in sorted(set(loaded)):
        if ranges and ranges[-1][-1] == month - 1:
            ranges[-1].append(month)
        else:
            ranges.append([month])
    if full_refresh and ranges:
        refresh(store, full_refresh=True, zones=zones)
    else:
        for span in ranges:
            start, last = month_bounds(year, span[0])[0], month_bounds(year, span[-1])[1]
            refresh(store, start=str(start), zones=zones, end=str(last + timedelta(days=1)))
    return {
        "successful": loaded, "failed": [m for m in months if m in errors], "errors": errors,
        "total": len(months),
    }
