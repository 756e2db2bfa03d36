"""Benchmark: refreshes of the facts, the quality suite, reports and metric queries.

Prints one JSON line. ``BENCH_SF_DIR`` names the input folder and ``BENCH_CPUS`` the cores.
Every step runs twice and the better time counts, so class loading and code generation of a
fresh JVM are not part of it; ``cold`` has the first times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
CUT = "2001-06-01"  # the last months of taxi data and all bike data come after it


def main() -> None:
    from citytrips import fixtures
    from citytrips.operators.staging import stg_bike, stg_fhv, stg_weather, stg_yellow
    from citytrips.plans import metrics, pipeline, quality, reports, suites
    from citytrips.plans.semantic import query
    from citytrips.session import get_session
    from citytrips.sources.ingest import with_month
    from citytrips.sources.tables import MONTH, write_table
    from pyspark.sql import functions as F

    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = get_session("bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"{work}/shared",
    })
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    def timed(name: str, step: Callable[[], object], runs: int = 2) -> None:
        for run in range(runs):
            start = time.perf_counter()
            step()
            spent = time.perf_counter() - start
            if run == 0:
                cold[name] = round(spent, 3)
            times[name] = round(min(spent, times.get(name, spent)), 3)

    # Raw tables, as an ingestion would have left them.
    projected = fixtures.ProjectedStore(spark, work, FOLDER)
    for table in ("yellow_taxi", "fhv_taxi", "trips", "hourly_weather"):
        write_table(with_month(projected.raw(table), table), f"{work}/raw/{table}", MONTH)
    write_table(projected.zones(), f"{work}/seed")
    zones = spark.read.parquet(f"{work}/seed")

    store = pipeline.Store(spark, work, fixtures.MIN_PICKUP)
    timed("full_refresh", lambda: pipeline.refresh(store, full_refresh=True, zones=zones))

    tables = {name: store.table(name) for name in (
        "fct_trips", "fct_hourly_mobility", "dim_date", "dim_time", "dim_location")}
    fct = tables["fct_trips"]
    rows = fct.count()
    dates, hours, places = (tables[n] for n in ("dim_date", "dim_time", "dim_location"))
    weather = store.table("dim_weather")
    staged = {"stg_yellow": stg_yellow(store.raw("yellow_taxi"), store.min_pickup),
              "stg_fhv": stg_fhv(store.raw("fhv_taxi"), store.min_pickup),
              "stg_bike": stg_bike(store.raw("trips")), "stg_weather": stg_weather(store.raw("hourly_weather"))}
    known = {**staged, "dim_date": dates, "dim_time": hours, "dim_location": places,
             "dim_weather": weather, "fct_trips": fct,
             "fct_hourly_mobility": tables["fct_hourly_mobility"]}
    timed("quality_suite", lambda: quality.run_suite(
        fct, suites.DECLARED["fct_trips"], known).collect())
    timed("quality_all_suites", lambda: [
        quality.run_suite(known[name], rules_, known).collect()
        for name, rules_ in suites.DECLARED.items()])
    for name in (
        "key_metrics", "daily_by_mode", "hourly_by_mode", "temperature_buckets", "rain_levels",
        "mode_comparison", "weekend_split", "data_summary", "monthly_by_mode", "daily_totals",
        "month_mode_pivot", "weather_correlation", "mode_share", "dataset_summary",
    ):
        timed(name, lambda f=getattr(reports, name): f(fct).collect())
    timed("weekday_pattern", lambda: reports.weekday_pattern(fct, dates).collect())
    timed("hourly_profile", lambda: reports.hourly_profile(fct, dates, hours).collect())
    timed("top_zones", lambda: reports.top_zones(fct, places).collect())
    timed("month_validation", lambda: reports.month_validation(fct, 1998, 6).collect())
    timed("date_gaps", lambda: quality.date_gaps(fct).collect())
    timed("weather_coverage", lambda: quality.weather_coverage(fct).collect())

    known = {"fct_trips": fct, "fct_hourly_mobility": tables["fct_hourly_mobility"],
             "date": dates, "time": hours, "location": places}
    timed("metric_one", lambda: query(
        metrics.TRIPS, known, ["total_trips"], ["trip_type"]).collect())
    timed("metric_all_50", lambda: query(
        metrics.TRIPS, known, list(metrics.TRIPS.metrics), ["trip_type"]).collect())
    timed("metric_joined", lambda: query(
        metrics.TRIPS, known, ["total_trips", "avg_fare"],
        ["date__is_weekend", "pickup_location__borough"]).collect())

    # Incremental: take the last months out of the facts, then add them again.
    timed("backfill_from_date", lambda: pipeline.refresh(store, start=CUT, zones=zones))
    later = store.table("fct_trips").filter(F.col("pickup_datetime") >= F.lit(CUT).cast("timestamp_ntz")).count()

    def cut_back() -> None:
        for name, column in (("fct_trips", "pickup_datetime"),
                             ("fct_hourly_mobility", "hour_timestamp")):
            kept = store.table(name).filter(F.col(column) < F.lit(CUT).cast("timestamp_ntz"))
            kept.write.mode("overwrite").partitionBy(MONTH).parquet(f"{work}/cut/{name}")
            write_table(spark.read.parquet(f"{work}/cut/{name}"), store.path(name), MONTH)

    for run in range(2):
        cut_back()
        timed("incremental_refresh", lambda: pipeline.refresh(store, zones=zones), runs=1)
    times["incremental_refresh"] = min(times["incremental_refresh"], cold["incremental_refresh"])

    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "sf": FOLDER.rsplit("sf", 1)[-1],
        "trips": rows,
        "trips_per_second_full_refresh": round(rows / times["full_refresh"]),
        "trips_per_second_incremental": round(later / times["incremental_refresh"]),
        "trips_per_second_backfill": round(later / times["backfill_from_date"]),
        "cpus": int(CPUS),
        "memory": "12g",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
