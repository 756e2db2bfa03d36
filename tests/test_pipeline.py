"""Monthly runs and backfills on landed files, end to end."""

from __future__ import annotations

import json
import time
from datetime import datetime, timedelta

import pytest
from citytrips.plans import pipeline
from citytrips.plans.pipeline import Store
from citytrips.sources import tables
from citytrips.sources.ingest import merge_raw
from conftest import values
from pyspark.sql import functions as F

DAYS = {1: 3, 2: 4, 3: 2}  # month → days with trips


def land(spark, folder, month: int, days: int) -> None:
    starts = [datetime(2025, month, d + 1, 8, 15) for d in range(days)]
    spark.createDataFrame(
        [(1, s, s + timedelta(minutes=12), 161, 10, 3.0, 15.0) for s in starts],
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
        " PULocationID bigint, DOLocationID bigint, trip_distance double, total_amount double",
    ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/yellow_tripdata_2025-{month:02d}.parquet")
    spark.createDataFrame(
        [("B1", s, s + timedelta(minutes=20), 161, 20) for s in starts],
        "dispatching_base_num string, pickup_datetime timestamp_ntz,"
        " dropOff_datetime timestamp_ntz, PUlocationID bigint, DOlocationID bigint",
    ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/fhv_tripdata_2025-{month:02d}.parquet")
    with open(f"{folder}/2025{month:02d}-citibike-tripdata.csv", "w") as file:
        file.write("ride_id,rideable_type,started_at,ended_at,start_station_id,member_casual\n")
        for s in starts:
            file.write(f"R{s:%m%d},classic_bike,{s},{s + timedelta(minutes=9)},1.1,member\n")
    hours = [f"2025-{month:02d}-{d + 1:02d}T{h:02d}:00" for d in range(days) for h in range(24)]
    fields = ("temperature_2m", "apparent_temperature", "relative_humidity_2m", "dew_point_2m",
              "precipitation", "rain", "snowfall", "cloud_cover", "pressure_msl",
              "wind_speed_10m", "wind_direction_10m")
    with open(f"{folder}/weather_2025-{month:02d}.json", "w") as file:
        json.dump({"hourly": {"time": hours, **{f: [1.0] * len(hours) for f in fields}}}, file)


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for month, days in DAYS.items():
        land(spark, str(folder), month, days)
    return str(folder)


def per_month(store):
    fct = store.table("fct_trips").groupBy("pickup_month").count()
    return dict(values(fct, "pickup_month", "count"))


def test_months_load_once_and_in_any_order(spark, landing, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    first = pipeline.run_month(store, landing, 2025, 2)
    assert (first.status, first.total_trips) == ("validated", 12)
    assert values(first.by_mode, "trip_type", "trip_count") == [
        ("citibike", 4), ("fhv", 4), ("yellow_taxi", 4)]
    assert {r["status"] for r in first.report.collect()} == {"success"}

    again = pipeline.run_month(store, landing, 2025, 2)
    assert again.total_trips == 12 and per_month(store) == {202502: 12}

    later = pipeline.run_month(store, landing, 2025, 3)
    assert later.total_trips == 6 and per_month(store) == {202502: 12, 202503: 6}

    # January lies before the high-water mark: nothing arrives until it is asked for.
    missed = pipeline.run_month(store, landing, 2025, 1)
    assert (missed.status, missed.total_trips) == ("error_no_data", 0)
    done = pipeline.backfill(store, landing, 2025, [1])
    assert done == {"successful": [1], "failed": [], "errors": {}, "total": 1}
    assert per_month(store) == {202501: 9, 202502: 12, 202503: 6}

    hourly = store.table("fct_hourly_mobility")
    assert hourly.count() == 27 and hourly.select("hour_key").distinct().count() == 27
    assert store.table("dim_date").count() == 28 + 31 + 2  # 2025-01-01 to 2025-03-02
    assert store.table("fct_trips").filter("temp_category is null").isEmpty()


def test_incremental_equals_full(spark, landing, tmp_path):
    step, full = (Store(spark, str(tmp_path / n)) for n in ("step", "full"))
    for month in (1, 2):
        pipeline.run_month(step, landing, 2025, month)
        pipeline.ingest(spark, landing, full.root, 2025, [month])
    pipeline.refresh(full, full_refresh=True)
    for name in ("fct_trips", "fct_hourly_mobility", "dim_date", "dim_time", "dim_weather"):
        a, b = step.table(name), full.table(name)
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count(), name


def test_a_plain_refresh_repairs_changed_weather_only(spark, landing, tmp_path):
    store, full = (Store(spark, str(tmp_path / n)) for n in ("store", "full"))
    for month in (1, 2):
        pipeline.run_month(store, landing, 2025, month)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "core" / "fct_trips").glob("*/*.parquet")}
    pipeline.refresh(store)
    assert files == {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "core" / "fct_trips").glob("*/*.parquet")}

    raw = store.raw("hourly_weather")
    hour = raw.filter("pickup_month = 202502").agg(F.max("timestamp")).first()[0]
    busy = store.table("fct_trips").filter("pickup_month = 202502").select(F.date_trunc("hour", "pickup_datetime").cast("timestamp_ntz")).first()[0]
    late = raw.filter(F.col("timestamp").isin(hour, busy)).withColumn("temp", F.lit(40.0))
    merge_raw(spark, store.root, "hourly_weather", late.drop("pickup_month"))
    merge_raw(spark, full.root, "hourly_weather", store.raw("hourly_weather").drop("pickup_month"))
    for name in ("yellow_taxi", "fhv_taxi", "trips"):
        merge_raw(spark, full.root, name, store.raw(name).drop("pickup_month"))
    pipeline.refresh(store)
    pipeline.refresh(full, full_refresh=True)
    assert not store.table("fct_trips").filter("temperature_celsius = 40").isEmpty()
    for name in ("fct_trips", "fct_hourly_mobility", "dim_weather", pipeline.DIGESTS):
        a, b = store.table(name), full.table(name)
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count(), name
    kept = {f: t for f, t in files.items() if "202501" in str(f)}
    assert kept and all(f.stat().st_mtime_ns == t for f, t in kept.items())


@pytest.mark.parametrize("few", [10 ** 6, 0])
def test_repaired_trips_are_not_shuffled_or_merged(spark, landing, tmp_path, monkeypatch, few):
    """One hour gets warmer, one loses its weather: its months are written as they are read."""
    monkeypatch.setattr(pipeline, "FEW_HOURS", few)
    store = Store(spark, str(tmp_path / "store"))
    for month in (1, 2):
        pipeline.run_month(store, landing, 2025, month)
    trips = store.table("fct_trips")
    gone, warm = datetime(2025, 1, 1, 8), datetime(2025, 1, 2, 8)
    before = values(trips.filter("pickup_month = 202502"))
    kept = values(trips.filter("pickup_datetime >= '2025-01-03' and pickup_month = 202501"))
    weather = store.weather().filter(F.col("timestamp") != F.lit(gone)).withColumn(
        "temp", F.when(F.col("timestamp") == F.lit(warm), 40.0).otherwise(F.col("temp")))
    merged, written, merge, write = [], [], pipeline.merge_into, pipeline.overwrite_months
    monkeypatch.setattr(pipeline, "merge_into", lambda s, path, *a: (merged.append(path), merge(s, path, *a)))
    monkeypatch.setattr(pipeline, "overwrite_months", lambda df, *a, **k: (
        written.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k)))
    pipeline.repair_weather(store, weather)
    assert merged == [store.path("fct_hourly_mobility")] and len(written) == 1
    first = next(line for line in written[0].splitlines() if "Join" in line or "Exchange" in line)
    assert few == 0 or "BroadcastHashJoin" in first
    after = store.table("fct_trips")
    assert values(after.filter("pickup_month = 202502")) == before
    assert values(after.filter("pickup_datetime >= '2025-01-03' and pickup_month = 202501")) == kept
    found = values(after.filter("pickup_datetime < '2025-01-03'"), "pickup_datetime", "temperature_celsius", "rain")
    assert {(at.day, temp, rain) for at, temp, rain in found} == {(1, None, None), (2, 40.0, 1.0)} and len(found) == 6
    hours = store.table("fct_hourly_mobility").filter("hour_timestamp < '2025-01-03'")
    assert values(hours, "hour_timestamp", "avg_temperature_celsius", "trip_count") == [
        (gone, None, 1)] * 3 + [(warm, 40.0, 1)] * 3


def test_hours_that_differ(spark):
    def weather(*rows):
        return spark.createDataFrame([(datetime(2025, 1, 1, h), a, b) for h, a, b in rows], "timestamp timestamp_ntz, a double, b double")

    before = pipeline.weather_digests(weather((1, 1.0, None), (2, 2.0, 2.0), (3, None, 3.0), (4, 4.0, 4.0)))
    now = weather((1, None, 1.0), (2, 2.0, 2.0), (3, None, 3.5), (5, None, None))
    assert sorted(r[0].hour for r in pipeline.changed_hours(now, before).collect()) == [1, 3, 4, 5]
    assert pipeline.changed_hours(now, None).count() == 4 and pipeline.changed_hours(now, pipeline.weather_digests(now)).isEmpty()


def test_backfill_stops_or_goes_on(spark, tmp_path):
    class Result:
        def __init__(self, status):
            self.status = status

    def run(store, landing, year, month, sources, **options):
        if month == 2:
            raise OSError("no such file")
        return Result("error_no_data" if month == 4 else "validated")

    store = Store(spark, str(tmp_path))
    stopped = pipeline.backfill(store, "", 2025, [1, 2, 3], run=run)
    assert (stopped["successful"], stopped["failed"], stopped["total"]) == ([1], [2], 3)
    whole = pipeline.backfill(store, "", 2025, [1, 2, 3, 4], run=run, continue_on_error=True)
    assert (whole["successful"], whole["failed"]) == ([1, 3], [2, 4])
    assert "no such file" in whole["errors"][2]


def test_a_ride_may_move_to_another_month(spark, landing, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    pipeline.run_month(store, landing, 2025, 1)
    with open(f"{landing}/202502-citibike-tripdata.csv", "a") as file:
        file.write("R0101,classic_bike,2025-02-20 08:00:00,2025-02-20 08:05:00,1.1,member\n")
    pipeline.run_month(store, landing, 2025, 2)
    rides = store.table("fct_trips").filter("trip_id = 'R0101'")
    assert values(rides, "pickup_month", "trip_duration_minutes") == [(202502, 5)]


def test_repeated_weather_hours_are_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    hour = datetime(2025, 1, 1, 1)
    row = spark.createDataFrame([(hour, 1.0)], "timestamp timestamp_ntz, temp double")
    tables.write_table(row.unionByName(row).withColumn(
        "pickup_month", row["temp"].cast("int") * 202501), f"{store.root}/raw/hourly_weather",
        "pickup_month")
    with pytest.raises(pipeline.DuplicateHours):
        pipeline.write_weather(store)


def test_backfill_rebuilds_each_month_once(spark, landing, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    pipeline.run_month(store, landing, 2025, 3)
    spans = []
    whole = pipeline.refresh
    monkeypatch.setattr(pipeline, "refresh", lambda *a, **k: (spans.append((k["start"], k["end"])), whole(*a, **k)))
    done = pipeline.backfill(store, landing, 2025, [1, 2, 12], continue_on_error=True)
    assert (done["successful"], done["failed"]) == ([1, 2], [12])
    assert spans == [("2025-01-01", "2025-03-01")]
    assert per_month(store) == {202501: 9, 202502: 12, 202503: 6}
    hours = store.table("fct_hourly_mobility").groupBy().sum("trip_count").first()[0]
    assert hours == 27


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(spark.range(5), path)
    with pytest.raises(Exception):
        tables.write_table(spark.range(9).selectExpr("assert_true(id < 3) as a", "id"), path)
    assert tables.read_table(spark, path).count() == 5


@pytest.mark.parametrize("threshold", ["-1", "64m"])
def test_months_are_written_by_few_tasks_under_either_join(spark, landing, tmp_path, threshold):
    store = Store(spark, str(tmp_path / "store"))
    for month in DAYS:
        pipeline.ingest(spark, landing, store.root, 2025, [month])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        pipeline.refresh(store, full_refresh=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(list((tmp_path / "store/core/fct_trips").glob("*/part-*"))) == 3


def test_trips_travel_narrow_and_unchanged(spark, folder):
    """Digests, other ids and missing ones come through the rebalance as they were."""
    from checks.workspace import Workspace

    trips = Workspace(spark, folder).trips()
    odd = spark.createDataFrame([(x, None) for x in ("R1", "AB", "abc", "", None, "0a")], "trip_id string, m string")
    odd = odd.select("trip_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in trips.schema.fields[1:]])
    both = trips.unionByName(odd)
    dealt = pipeline.dealt_by_month(both)
    assert dealt.columns == both.columns
    assert both.exceptAll(dealt).isEmpty() and dealt.exceptAll(both).isEmpty()


def test_refresh_lands_and_sorts_trips_while_they_are_narrow(spark, landing, tmp_path, monkeypatch):
    store, written, write = Store(spark, str(tmp_path / "store")), [], tables._write_months
    pipeline.run_month(store, landing, 2025, 1)
    monkeypatch.setattr(tables, "_write_months", lambda df, path, column, order_by, *a: (written.append((
        path, df.sortWithinPartitions(column, *order_by)._jdf.queryExecution().executedPlan().toString())),
        write(df, path, column, order_by, *a)))
    pipeline.run_month(store, landing, 2025, 2)
    plan, = [p for path, p in written if path == store.path("fct_trips")]
    above, below = plan.split("BroadcastHashJoin", 1)
    assert "Sort" not in above and "Sort" in below
    assert "temp_category" not in spark.read.parquet(f"{store.root}/staging/fct_trips").columns
    added = values(store.table("fct_trips").filter("pickup_month = 202502"))
    pipeline.refresh(store, full_refresh=True)
    assert added and added == values(store.table("fct_trips").filter("pickup_month = 202502"))


def test_build_sorts_trips_while_they_are_narrow(spark, folder, tmp_path):
    from citytrips.fixtures import ProjectedStore

    store = ProjectedStore(spark, str(tmp_path), folder)
    fct, dealt = pipeline.dealt_trips(store.trips(), pipeline.write_weather(store))
    plan = fct.sortWithinPartitions("pickup_month", "pickup_datetime")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("BroadcastHashJoin", 1)
    assert dealt and "Sort" not in above
    assert "Sort" in below[:below.index("REBALANCE")] and "trip_key" not in below[below.index("Sort"):]
    parts = fct.select(F.spark_partition_id().alias("p"), "pickup_month", "pickup_datetime").collect()
    assert all(a[1:] <= b[1:] for a, b in zip(parts, parts[1:]) if a.p == b.p)
    pipeline.write_trips(store, store.table("dim_weather"))
    for file in (tmp_path / "core" / "fct_trips").glob("*/part-*"):
        at = [r[0] for r in spark.read.parquet(str(file)).select("pickup_datetime").collect()]
        assert at == sorted(at)


def test_build_shuffles_no_weather_of_trips(spark, folder, tmp_path, monkeypatch):
    from citytrips.fixtures import ProjectedStore

    store, written = ProjectedStore(spark, str(tmp_path), folder), []
    monkeypatch.setattr(pipeline, "write_table", lambda df, *a, **k: written.append((df, k)))
    weather = store.weather()
    for limit in (10 ** 6, 0):
        monkeypatch.setattr(pipeline, "FEW_HOURS", limit)
        pipeline.write_trips(store, weather)
    assert [k["dealt"] for _, k in written] == [True, False]
    plan = written[0][0]._jdf.queryExecution().optimizedPlan().toString()
    assert "temp_category" not in plan[plan.index("RebalancePartitions"):plan.index("Union")]
    few, many = (df.drop("pickup_month") for df, _ in written)
    assert few.exceptAll(many).isEmpty() and few.count() == many.count()


def test_ranges_hold_every_month_and_a_share_of_the_trips(monkeypatch):
    monkeypatch.setattr(pipeline, "RANGE_TRIPS", 0)
    counts = {None: 5, **{202401 + m: 10 for m in range(12)}, 202502: 400, 202503: 1}
    ranges = pipeline.month_ranges(counts)
    assert ranges[0][0] is None and ranges[-1][1] is None
    assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))
    inside = [sum(n for m, n in counts.items() if (f is None or m is not None and m >= f) and (t is None or m is None or m <= t))
              for f, t in ranges]
    assert sum(inside) == sum(counts.values()) and inside == [65, 60, 400, 1]
    assert pipeline.month_ranges({}) == [(None, None)] == pipeline.month_ranges({None: 9})
    monkeypatch.setattr(pipeline, "RANGE_TRIPS", 10 ** 6)
    assert pipeline.month_ranges(counts) == [(None, None)]


def test_many_trips_are_built_repaired_and_refreshed_range_by_range(spark, folder, tmp_path, monkeypatch):
    """The share of the trips that lies beside the tables at a time is small; results are those of one range."""
    from citytrips.fixtures import ProjectedStore

    class Late(ProjectedStore):
        warmer = False

        def raw(self, name):
            df = super().raw(name)
            if name == "trips":  # one ride has no start, so it lies in no month
                return df.withColumn("started_at", F.expr("if(ride_id = 'R7', null, started_at)"))
            return df.withColumn("temp", F.col("temp") + 20) if self.warmer and name == "hourly_weather" else df

    stores, landed, land, write = [], [], pipeline.stage, tables._write_months

    def note(df, path):
        out = land(df, path)
        landed.append((path, out.count()))
        return out

    written = []
    monkeypatch.setattr(pipeline, "RANGES", 4, raising=False)
    monkeypatch.setattr(pipeline, "stage", note)
    monkeypatch.setattr(tables, "_write_months", lambda df, path, *a: (written.append((path, df.count())), write(df, path, *a)))
    for name, least in (("whole", 10 ** 9), ("cut", 0)):
        monkeypatch.setattr(pipeline, "RANGE_TRIPS", least, raising=False)
        stores.append(Late(spark, str(tmp_path / name), folder))
        pipeline.refresh(stores[-1])
        stores[-1].warmer = True
        pipeline.refresh(stores[-1], start="1990-01-01")
    whole, cut = stores
    total = cut.table("fct_trips").count()
    assert cut.table("fct_trips").filter("pickup_month is null").count() == 1
    assert max(n for path, n in landed if path == f"{cut.root}/staging/fct_trips") < total / 2
    assert max(n for path, n in written if path.startswith(cut.path("fct_trips"))) < total / 2
    assert sum(n for path, n in landed if path == f"{cut.root}/staging/fct_trips") == total - 1
    for name in ("fct_trips", "fct_hourly_mobility", "dim_date", "dim_time", "dim_weather", pipeline.DIGESTS):
        a, b = whole.table(name), cut.table(name)
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count() > 0, name


def test_a_range_is_cut_before_trips_are_shuffled(spark, folder, tmp_path, monkeypatch):
    from citytrips.fixtures import ProjectedStore

    monkeypatch.setattr(pipeline, "RANGE_TRIPS", 0)
    parts = pipeline.trips_in_ranges(ProjectedStore(spark, str(tmp_path), folder))
    plan = parts[1]._jdf.queryExecution().optimizedPlan().toString()
    assert len(parts) > 4 and plan.count("Window [") == 2
    for below in plan.split("Window [")[1:]:
        assert "Filter" in below[:below.index("Relation")] and below[:below.index("Relation")].count(" >= ") >= 2


def test_shuffle_files_go_with_a_refresh(spark, folder, tmp_path):
    from citytrips.fixtures import ProjectedStore

    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {n for n in files.mkString("\n").split("\n") if "/shuffle_" in n}

    before = shuffled()
    store = ProjectedStore(spark, str(tmp_path), folder)
    pipeline.refresh(store)
    pipeline.refresh(store, start="1990-01-01")
    for _ in range(40):  # they are deleted in the background
        if not shuffled() - before:
            break
        time.sleep(0.5)
    assert not shuffled() - before


def test_pickups_of_a_range_are_those_of_its_months(spark):
    times = ["-0003-05-01 00:00:00", "0001-01-01 00:00:00", "1999-12-31 23:59:59.999999", "2000-01-01 00:00:00",
             "2000-11-30 12:00:00", "2000-12-31 23:59:59", "2001-01-01 00:00:00", "+12000-01-01 00:00:00", None]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("pickup_datetime"))
    month = F.year("pickup_datetime") * 100 + F.month("pickup_datetime")
    assert rows.filter(month.isNull()).count() == 1
    for first, last in ((None, None), (None, 199912), (None, 200012), (200001, 200012), (200012, 200012), (200101, None), (101, 200011), (200001, 200100), (-295, 1200001)):
        same = pipeline.picked_up_within(first, last).eqNullSafe(pipeline.within(month, first, last))
        wrong = rows.filter(~same & F.col("pickup_datetime").isNotNull())
        assert wrong.isEmpty()
        assert rows.filter(pipeline.picked_up_within(first, last)).filter(month.isNull()).count() == (first is None)


def test_landed_trips_are_sorted_for_the_write_only(spark, folder, tmp_path, monkeypatch):
    from citytrips.fixtures import ProjectedStore

    store, merged, merge = ProjectedStore(spark, str(tmp_path), folder), [], pipeline.merge_into
    monkeypatch.setattr(pipeline, "merge_into", lambda s, path, batch, *a: (merged.append((path, batch)), merge(s, path, batch, *a)))
    pipeline.refresh(store)
    pipeline.refresh(store, start="1990-01-01")
    batch, = [b for path, b in merged if path == store.path("fct_trips")]
    plan = batch.select("trip_key")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Scan" in plan
