"""Readers on files written by the tests."""

from __future__ import annotations

import json
import os
import zipfile
from datetime import date, datetime

import pytest
from citytrips import schemas
from citytrips.sources import columns, inventory, months, trips, weather, zones
from citytrips.sources.ingest import ingest, raw_table, select_tables
from citytrips.sources.report import report_frame
from conftest import values
from pyspark.sql import functions as F


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def write_yellow(spark, folder, year, month, *rows, **extra):
    data = [(1, at(p), at(p), 161, fare) for p, fare in rows]
    df = spark.createDataFrame(data, "VendorID bigint, tpep_pickup_datetime timestamp_ntz,"
                               " tpep_dropoff_datetime timestamp_ntz, PULocationID bigint,"
                               " fare_amount double")
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    df.coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/yellow_tripdata_{year}-{month:02d}.parquet")


def write_zip(folder, name, members: dict[str, str]):
    with zipfile.ZipFile(os.path.join(folder, name), "w", zipfile.ZIP_DEFLATED) as archive:
        for member, text in members.items():
            archive.writestr(member, text)


def test_months():
    assert months.validate_months("1, 12") == [1, 12]
    for wrong in ([0], [13], [], "x"):
        with pytest.raises(ValueError):
            months.validate_months(wrong)
    assert months.month_bounds(2024, 12) == (date(2024, 12, 1), date(2024, 12, 31))
    assert months.month_bounds(2024, 2) == (date(2024, 2, 1), date(2024, 2, 29))


def test_snake_case():
    names = {"VendorID": "vendor_id", "PULocationID": "pu_location_id",
             "PUlocationID": "p_ulocation_id", "DOlocationID": "d_olocation_id",
             "dropOff_datetime": "drop_off_datetime", "RatecodeID": "ratecode_id",
             "Airport_fee": "airport_fee", "ride id": "ride_id"}
    assert {n: columns.snake_case(n) for n in names} == names


def test_yellow_months_in_order_and_missing_ones_reported(spark, tmp_path):
    folder = str(tmp_path)
    write_yellow(spark, folder, 2025, 1, ("2025-01-01 00:00:00", 10.5))
    write_yellow(spark, folder, 2025, 3, ("2025-03-01 00:00:00", 15.0))
    frame, entries = trips.load_yellow(spark, folder, 2025, [1, 2, 3])
    assert values(frame, "fare_amount", "pu_location_id") == [(10.5, 161), (15.0, 161)]
    assert frame.columns == schemas.RAW_YELLOW.fieldNames()
    assert [(e.month, e.status, e.error) for e in entries] == [
        (1, "success", None), (2, "failed", "PATH_NOT_FOUND"), (3, "success", None)]
    assert report_frame(spark, entries).count() == 3
    with pytest.raises(FileNotFoundError):
        trips.read_yellow(spark, folder, 2024, [1])


def test_a_damaged_month_does_not_stop_the_others(spark, tmp_path):
    write_yellow(spark, str(tmp_path), 2025, 1, ("2025-01-01 00:00:00", 10.5))
    (tmp_path / "yellow_tripdata_2025-02.parquet").write_bytes(b"not parquet at all")
    frame, entries = trips.load_yellow(spark, str(tmp_path), 2025, [1, 2])
    assert frame.count() == 1 and [e.status for e in entries] == ["success", "failed"]


def test_empty_month(spark, tmp_path):
    write_yellow(spark, str(tmp_path), 2025, 1)
    assert trips.read_yellow(spark, str(tmp_path), 2025, [1]).count() == 0


def test_new_and_retyped_columns(spark, tmp_path):
    folder = str(tmp_path)
    write_yellow(spark, folder, 2025, 1, ("2025-01-01 00:00:00", 1.0), passenger_count=2)
    write_yellow(spark, folder, 2025, 2, ("2025-02-01 00:00:00", 2.0), passenger_count=3.0,
                 new_column="x")
    frame = trips.read_yellow(spark, folder, 2025, [1, 2])
    assert values(frame, "fare_amount", "passenger_count", "new_column") == [
        (1.0, 2, None), (2.0, 3, "x")]


BIKE = "ride_id,rideable_type,started_at,ended_at,start_station_id,start_lat,member_casual\n"
RIDE = "{0},classic_bike,2025-05-01 08:00:00.123,2025-05-01 08:30:00,7531.10,40.7,member\n"


def test_bike_archives_with_several_members(spark, tmp_path):
    write_zip(tmp_path, "202505-citibike-tripdata.zip", {
        "a.csv": BIKE + "".join(RIDE.format(f"A{i}") for i in range(3)),
        "b.csv": BIKE.replace("\n", ",battery\n") + RIDE.format("B").replace("\n", ",80\n"),
        "readme.txt": "no data",
    })
    (tmp_path / "202507-citibike-tripdata.zip").write_bytes(b"broken" * 50)
    frame, entries = trips.load_bike(spark, str(tmp_path), 2025, [5, 6, 7])
    assert values(frame, "ride_id", "start_station_id", "battery") == [
        ("A0", "7531.10", None), ("A1", "7531.10", None), ("A2", "7531.10", None),
        ("B", "7531.10", "80")]
    assert frame.first()["started_at"].microsecond == 123000
    assert [(e.month, e.status) for e in entries] == [
        (5, "success"), (6, "failed"), (7, "failed")]
    assert "BadZipFile" in entries[2].error


def test_large_members_stream_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trips, "CSV_CHUNK_ROWS", 100)
    write_zip(tmp_path, "202505-citibike-tripdata.zip", {
        "a.csv": BIKE + "".join(RIDE.format(i) for i in range(1050))})
    frame = trips.read_bike(spark, str(tmp_path), 2025, [5])
    assert frame.select("ride_id").distinct().count() == 1050


def test_unpacked_csv_goes_before_the_archive(spark, tmp_path):
    (tmp_path / "202505-citibike-tripdata.csv").write_text(BIKE + RIDE.format("csv"))
    write_zip(tmp_path, "202505-citibike-tripdata.zip", {"a.csv": BIKE + RIDE.format("zip")})
    write_zip(tmp_path, "202506-citibike-tripdata.zip", {"a.csv": BIKE + RIDE.format("june")})
    frame = trips.read_bike(spark, str(tmp_path), 2025, [5, 6])
    assert values(frame, "ride_id") == [("csv",), ("june",)]


PAYLOAD = {"hourly": {
    "time": ["2023-10-01T00:00", "2023-10-01T01:00"], "temperature_2m": [20.5, None],
    "relative_humidity_2m": [65, 66], "dew_point_2m": [13.5, 13.0],
    "apparent_temperature": [19.5, 19.0], "precipitation": [0.0, 1.5], "rain": [0.0, 1.5],
    "snowfall": [0.0, 0.0], "cloud_cover": [25, 100], "pressure_msl": [1013.2, 1012.0],
    "wind_speed_10m": [3.5, 4.5], "wind_direction_10m": [180, 190]}}


def test_weather_fields(spark, tmp_path):
    path = tmp_path / "weather_2023-10.json"
    path.write_text(json.dumps(PAYLOAD))
    first, second = sorted(weather.read_weather(spark, str(path)).collect())
    assert tuple(first) == (at("2023-10-01 00:00:00"), 20.5, 19.5, 65, 13.5, 0.0, 0.0, 0.0, 25,
                            1013.2, 3.5, 180)
    assert second["temp"] is None and second["precipitation"] == 1.5


def test_weather_without_hours_fails_its_month(spark, tmp_path):
    (tmp_path / "weather_2023-10.json").write_text(json.dumps(PAYLOAD))
    (tmp_path / "weather_2023-11.json").write_text('{"error": true}')
    (tmp_path / "weather_2023-12.json").write_text('{"hourly": {"time": []}}')
    frame, entries = weather.load_weather(spark, str(tmp_path), 2023, [9, 10, 11, 12])
    assert frame.count() == 2
    assert [e.status for e in entries] == ["failed", "success", "failed", "failed"]


def test_zones(spark, tmp_path):
    (tmp_path / "z.csv").write_text("location_id,borough,zone,service_zone\n1,EWR,Newark Airport,EWR\n")
    assert values(zones.read_zones(spark, str(tmp_path / "z.csv"))) == [
        (1, "EWR", "Newark Airport", "EWR")]


def test_source_names():
    assert select_tables("taxi,weather") == ["yellow_taxi", "fhv_taxi", "hourly_weather"]
    assert select_tables(["fhv"]) == ["fhv_taxi"]
    with pytest.raises(ValueError):
        select_tables("taxi,trains")


def test_ingest_is_idempotent_and_grows_by_month(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "store")
    write_yellow(spark, landing, 2025, 1, ("2025-01-01 00:00:00", 1.0), ("2025-01-02 00:00:00", 2.0))
    write_yellow(spark, landing, 2025, 2, ("2025-02-01 00:00:00", 3.0), new_column="x")
    report = ingest(spark, landing, root, 2025, [1], "yellow")
    assert values(report, "month", "status", "rows") == [(1, "success", 2)]
    ingest(spark, landing, root, 2025, [1], ["yellow"])
    assert raw_table(spark, root, "yellow_taxi").count() == 2
    report = ingest(spark, landing, root, 2025, [2, 3], ["taxi"])
    assert values(report, "source", "month", "status", "rows") == [
        ("fhv_taxi", 2, "failed", None), ("fhv_taxi", 3, "failed", None),
        ("yellow_taxi", 2, "success", 1), ("yellow_taxi", 3, "failed", None)]
    loaded = raw_table(spark, root, "yellow_taxi")
    assert values(loaded, "fare_amount", "new_column") == [(1.0, None), (2.0, None), (3.0, "x")]


def test_file_inventory(spark, tmp_path):
    for name, size in (("a.zip", 100), ("b.zip", 100), ("c.zip", 400), ("d.txt", 5)):
        (tmp_path / name).write_bytes(b"x" * size * 1024)
    found = {r["file_name"]: r for r in inventory.file_inventory(
        spark, str(tmp_path), "*.zip", small_mb=0.2).collect()}
    assert set(found) == {"a.zip", "b.zip", "c.zip"}
    assert found["a.zip"]["avg_size_mb"] == pytest.approx(200 / 1024)
    assert found["c.zip"]["pct_from_avg"] == pytest.approx(100.0)
    assert [found[n]["is_suspicious"] for n in ("a.zip", "c.zip")] == [True, False]
    assert found["a.zip"]["is_deviating"]


def test_quoted_fields_read_alike_from_csv_and_archive(spark, tmp_path):
    text = ('﻿ride_id,start_station_name,member_casual,end_station_name\n'
            'A,"Broadway ""N"", 5 St",member,NA\nB,"1 Ave\n& E 4 St",casual,\n'
            'C,"a, b, ""c""",member,null\n')
    for folder in ("csv", "zip"):
        (tmp_path / folder).mkdir()
    (tmp_path / "csv" / "202505-citibike-tripdata.csv").write_text(text, encoding="utf-8")
    write_zip(tmp_path / "zip", "202505-citibike-tripdata.zip", {"a.csv": text})
    read = [values(trips.read_bike(spark, str(tmp_path / f), 2025, [5]), "ride_id",
                   "start_station_name", "member_casual", "end_station_name")
            for f in ("csv", "zip")]
    assert read[0] == read[1] == [
        ("A", 'Broadway "N", 5 St', "member", "NA"), ("B", "1 Ave\n& E 4 St", "casual", None),
        ("C", 'a, b, "c"', "member", "null")]


def test_a_damaged_body_fails_its_own_month_only(spark, tmp_path):
    landing, root = str(tmp_path), str(tmp_path / "raw-tables")
    for month in (1, 2, 3):
        write_yellow(spark, landing, 2025, month, *[
            (f"2025-{month:02d}-01 00:{k:02d}:00", float(k)) for k in range(60)])
    (part,) = (tmp_path / "yellow_tripdata_2025-02.parquet").glob("part-*.parquet")
    data = bytearray(part.read_bytes())
    data[4:200] = b"\x00" * 196  # pages, not the footer
    part.write_bytes(bytes(data))
    for check in part.parent.glob(".*.crc"):
        check.unlink()
    found = ingest(spark, landing, root, 2025, [1, 2, 3], ["yellow"]).collect()
    assert {r["month"]: r["status"] for r in found} == {1: "success", 2: "failed", 3: "success"}
    assert raw_table(spark, root, "yellow_taxi").count() == 120
    (error,) = [r["error"] for r in found if r["month"] == 2]
    assert error
