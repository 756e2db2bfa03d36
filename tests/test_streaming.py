"""Streams over arriving files."""

from __future__ import annotations

from datetime import datetime, timedelta

from citytrips import schemas
from citytrips.sources.ingest import raw_table
from citytrips.sources.tables import read_table
from citytrips.streaming import hourly as stream
from conftest import values
from pyspark.sql import functions as F

START = datetime(2025, 5, 1, 8, 10)
TRIPS = "trip_type string, pickup_datetime timestamp_ntz, revenue double, trip_distance double"


def rides(spark, *rows):
    known = {"ride_id": 0, "started_at": 1, "member_casual": 2}
    return spark.createDataFrame(
        [tuple(r[known[n]] if n in known else None for n in schemas.RAW_BIKE.fieldNames())
         for r in rows], schemas.RAW_BIKE)


def test_merge_stream_is_idempotent_and_resumes(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "root", "checkpoint"))

    def run():
        stream.merge_stream(spark, landing, root, "trips", checkpoint,
                            files_per_batch=1).awaitTermination()
        return values(raw_table(spark, root, "trips"), "ride_id", "member_casual")

    rides(spark, ("a", START, "member"), ("b", START, "member")).coalesce(1).write.parquet(landing)
    assert run() == [("a", "member"), ("b", "member")]
    rides(spark, ("b", START, "casual"), ("c", START, "casual")).coalesce(1).write.mode(
        "append").parquet(landing)
    assert run() == [("a", "member"), ("b", "casual"), ("c", "casual")]
    assert run() == [("a", "member"), ("b", "casual"), ("c", "casual")]


def test_hourly_stream_updates_open_hours_and_drops_late_rows(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "path", "checkpoint"))

    def run(*minutes):
        spark.createDataFrame(
            [("fhv", START + timedelta(minutes=m), 2.0, 1.0) for m in minutes], TRIPS
        ).coalesce(1).write.mode("append").parquet(landing)
        stream.hourly_stream(spark, landing, path, checkpoint,
                             spark.read.parquet(landing).schema).awaitTermination()
        return values(read_table(spark, path), F.hour("hour_timestamp"), "trip_count",
                      "total_revenue")

    assert run(0, 10) == [(8, 2, 4.0)]
    assert run(20, 60) == [(8, 3, 6.0), (9, 1, 2.0)]
    assert run(600) == [(18, 1, 2.0), (8, 3, 6.0), (9, 1, 2.0)]
    assert run(5) == [(18, 1, 2.0), (8, 3, 6.0), (9, 1, 2.0)]  # behind the watermark


def test_medians_of_closed_hours_with_late_rows_and_restarts(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("landing", "path", "checkpoint"))

    def run(*trips):
        """Each call is a restart with one more file."""
        spark.createDataFrame(
            [(mode, START + timedelta(minutes=m), 1.0, v) for mode, m, v in trips], TRIPS
        ).coalesce(1).write.mode("append").parquet(landing)
        stream.median_stream(spark, landing, path, checkpoint, spark.read.parquet(landing).schema,
                             ["trip_distance"], state_partitions=2).awaitTermination()
        found = read_table(spark, path)
        return [] if found is None else values(
            found, F.hour("hour_timestamp"), "trip_type", "trip_count", "median_trip_distance")

    assert run(("fhv", 0, 1.0), ("fhv", 5, 9.0), ("bike", 1, None), ("bike", 2, None)) == []
    assert run(("fhv", 60, 4.0), ("fhv", 10, 2.0), ("fhv", 11, 2.0)) == []  # late, the hour is open
    first = [(8, "bike", 2, None), (8, "fhv", 4, 2.0)]
    assert run(("fhv", 61, 5.0), ("bike", 180, -0.0), ("bike", 181, 0.5)) == first
    assert run(("fhv", 20, 99.0)) == first  # behind the watermark
    last = run(("fhv", 6000, 1.0))
    assert last == sorted([*first, (9, "fhv", 2, 4.5), (11, "bike", 2, 0.25)], key=repr)


def test_an_open_hour_keeps_arrays_of_counts():
    """What crosses to the state store does not grow by an entry for every value."""
    import pandas as pd

    class Kept(list):
        appendList, get, exists = list.extend, lambda self: iter(self), lambda self: bool(self)

    class Handle:
        timers, kept = set(), Kept()

        def getListState(self, *_):
            return self.kept

        def registerTimer(self, at):
            self.timers.add(at)

    hours, handle = stream.OpenHours(["revenue", "trip_distance"]), Handle()
    hours.init(handle)
    for frames in ([range(1, 1001), range(500, 700)], [[-0.0, None, 0.0]]):
        batch = [pd.DataFrame({"revenue": pd.Series(v, dtype="float64"), "trip_distance": None}) for v in frames]
        assert not list(hours.handleInputRows((0, "fhv"), iter(batch), None))
    assert len(handle.kept) <= 4
    row = next(hours.handleExpiredTimer((0, "fhv"), None, None)).iloc[0]
    assert (row["trip_count"], row["revenue"], row["trip_distance"]) == (1203, 549.5, None)
    assert not handle.kept
