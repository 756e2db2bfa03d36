"""What the physical plans look like, and results under skew."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from citytrips import schemas
from citytrips.operators import facts, staging
from citytrips.operators.dedup import keep_first
from citytrips.plans import quality, reports
from citytrips.sources.tables import read_table, write_table
from conftest import values
from pyspark.sql import functions as F


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fct_path(spark, tmp_path_factory):
    """A fact where one month and one hour hold most trips."""
    path = str(tmp_path_factory.mktemp("fct"))
    hot = F.lit(datetime(2025, 3, 1, 8)).cast("timestamp_ntz")
    spread = F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(
        hours=(F.col("id") % 2000).cast("int"))
    trips = spark.range(20_000).select(
        F.col("id").cast("string").alias("trip_id"), F.lit("fhv").alias("trip_type"),
        F.when(F.col("id") % 3 < 2, hot).otherwise(spread).alias("pickup_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("dropoff_datetime"),
        F.lit("5").alias("pickup_location_id"), F.lit("6").alias("dropoff_location_id"),
        F.lit(1).alias("passenger_count"), F.lit(2.0).alias("trip_distance"),
        F.lit(3.0).alias("revenue"), F.lit(1).alias("payment_type"),
        F.lit(None).cast("string").alias("member_type"),
        F.lit(None).cast("string").alias("rideable_type"))
    hours = spark.createDataFrame(
        [(datetime(2025, 1, 1) + timedelta(hours=i), float(i % 30)) for i in range(2000)],
        "timestamp timestamp_ntz, temp double")
    missing = [f for f in schemas.RAW_WEATHER.fields if f.name not in hours.columns]
    for field in missing:
        hours = hours.withColumn(field.name, F.lit(0).cast(field.dataType))
    from citytrips.operators.dims import dim_weather

    weather_path = str(tmp_path_factory.mktemp("weather"))
    write_table(dim_weather(staging.stg_weather(hours)), weather_path)
    weather = spark.read.parquet(weather_path)
    write_table(facts.fct_trips(trips, weather), path, "pickup_month", ("pickup_datetime",))
    return path


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = plan_of(keep_first(df, ["k"], [F.col("v").desc()]))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert before.count("WindowGroupLimit") == 1 and after.count("WindowGroupLimit") == 1
    assert values(keep_first(df, ["k"], [F.col("v").desc()])) == [(0, 998), (1, 999)]


def test_filters_and_columns_reach_the_scan(spark, fct_path):
    fct = read_table(spark, fct_path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(reports.key_metrics(staging.filter_trips(fct, "2025-02-10", "2025-03-05", "fhv")))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "EqualTo(trip_type,fhv)" in plan
    assert "pickup_month" in plan.split("PartitionFilters")[1].split("]")[0]
    columns = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "pickup_datetime", "trip_type", "trip_distance", "revenue", "trip_duration_minutes"}


def test_month_validation_reads_one_partition(spark, fct_path):
    fct = read_table(spark, fct_path)
    plan = plan_of(reports.month_validation(fct, 2025, 2))
    assert "pickup_month" in plan.split("PartitionFilters")[1].split("]")[0]


def test_weather_is_broadcast_by_size_only(spark, fct_path):
    fct = read_table(spark, fct_path)
    weather = fct.select(F.col("pickup_datetime").alias("timestamp"), "precipitation").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = facts.join_weather(fct.select("pickup_datetime"), weather)
        assert "SortMergeJoin" in plan_of(big) and "Broadcast" not in plan_of(big)
        assert big.count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))


def test_a_hot_month_is_split_when_written(spark, tmp_path):
    hot = F.when(F.col("id") % 3 < 2, 202503).otherwise(202502)
    rows = spark.range(0, 60_000, 1, 8).select(  # eight tasks, as a split is between map outputs
        F.md5(F.col("id").cast("string")).alias("k"), hot.alias("pickup_month"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        write_table(rows, str(tmp_path / "t"), "pickup_month", ("k",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t" / "pickup_month=202503").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_results_under_skew(spark, fct_path):
    fct = read_table(spark, fct_path)
    hourly = facts.fct_hourly(fct)
    assert hourly.agg(F.sum("trip_count")).first()[0] == 20_000
    assert hourly.agg(F.max("trip_count")).first()[0] > 13_000
    assert quality.key_health(fct).first()["duplicate_keys"] == 0
    assert reports.hourly_coverage(fct).agg(F.sum("trip_count")).first()[0] == 20_000


def test_aggregates_are_combined_before_each_shuffle(spark, fct_path):
    fct = read_table(spark, fct_path)
    for df in (reports.data_summary(fct), reports.mode_comparison(fct), facts.fct_hourly(fct)):
        plan = plan_of(df)
        assert "partial_" in plan.split("Exchange hashpartitioning", 1)[1]


def test_hourly_medians_hold_counts_of_values(spark, fct_path):
    """Beside the medians, whole trips would be sorted by the task that reads them."""
    fct = read_table(spark, fct_path)
    lines = [x for x in plan_of(facts.fct_hourly(fct)).splitlines() if "ObjectHashAggregate" in x]
    assert lines and not any("revenue" in x for x in lines)
    some = fct.limit(40).withColumns({
        "date_key": F.when(F.col("trip_id").cast("int") % 2 == 0, F.col("date_key")),
        "trip_distance": F.when(F.col("trip_id").cast("int") % 5 > 0, F.col("trip_id").cast("double"))})
    some = spark.createDataFrame(some.collect(), some.schema)
    keys = [*facts.HOUR_GROUP[:-1], F.date_trunc("hour", "pickup_datetime").cast("timestamp_ntz").alias("hour_timestamp")]
    plain = some.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trip_count"),
        *[F.percentile(c, 0.5).alias(n) for n, c in facts.HOUR_MEDIANS.items()])
    hourly = facts.fct_hourly(some)
    assert values(hourly, *plain.columns) == values(plain)
    assert not hourly.filter("date_key is null").isEmpty()
    assert not hourly.filter("median_trip_distance_miles is null").isEmpty()
