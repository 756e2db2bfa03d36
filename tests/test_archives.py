"""Archives of bike trips as a data source, and CSV files with and without breaks within quotes."""

from __future__ import annotations

import zipfile

from citytrips.sources import archives, trips
from citytrips.sources.ingest import raw_table
from conftest import values

HEADER = "ride_id,rideable_type,started_at,start_station_id,start_lat,member_casual\n"


def ride(name: str, kind: str = "member") -> str:
    return f"{name},classic_bike,2025-05-01 08:00:00.123,7531.10,40.7,{kind}\n"


def pack(folder, month: str, members: dict[str, str]) -> None:
    with zipfile.ZipFile(folder / f"{month}-citibike-tripdata.zip", "w", zipfile.ZIP_STORED) as out:
        for name, text in members.items():
            out.writestr(name, text)


def spoil(folder, month: str, old: bytes, new: bytes) -> None:
    """Change bytes of a member behind its checksum."""
    path = folder / f"{month}-citibike-tripdata.zip"
    path.write_bytes(path.read_bytes().replace(old, new))


def test_one_partition_a_member_and_damage_of_one_leaves_the_others(spark, tmp_path):
    pack(tmp_path, "202505", {"a.csv": HEADER + ride("a"), "b.csv": HEADER + ride("b"), "x.txt": "x"})
    pack(tmp_path, "202506", {"a.csv": HEADER + ride("kept"), "b.csv": HEADER + ride("spoiled") * 9})
    spoil(tmp_path, "202506", b"spoiled", b"SPOILED")
    pack(tmp_path, "202507", {"readme.txt": "no data"})
    pack(tmp_path, "202508", {"a.csv": HEADER + ride("fine") + "1,2,3,4,5,6,7,8,9\n", "b.csv": ""})
    (tmp_path / "202509-citibike-tripdata.zip").write_bytes(b"broken" * 50)
    rows = archives.read_archives(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 8
    assert values(archives.trips_of(rows), "ride_id", "start_station_id", "start_lat") == [
        ("a", "7531.10", 40.7), ("b", "7531.10", 40.7), ("kept", "7531.10", 40.7)]
    damage = {(r.archive_month, r.member): r.error for r in archives.damage_of(rows).collect()}
    assert set(damage) == {(202506, "b.csv"), (202507, None), (202508, "a.csv"), (202509, None)}
    assert "CRC" in damage[202506, "b.csv"] and "BadZipFile" in damage[202509, None]
    assert "ParserError" in damage[202508, "a.csv"] and damage[202507, None] == "no CSV member"
    report = archives.archive_report(spark, rows)
    assert values(report, "month", "status", "rows") == [
        (5, "success", 2), (6, "failed", 1), (7, "failed", 0), (8, "failed", 0), (9, "failed", 0)]


def test_some_months_further_columns_and_an_empty_folder(spark, tmp_path):
    pack(tmp_path, "202505", {"a.csv": HEADER.replace("\n", ",Battery Level\n")
                              + ride("a").replace("\n", ",80\n")})
    pack(tmp_path, "202506", {"a.csv": HEADER + ride("b")})
    june = archives.read_archives(spark, str(tmp_path), [202506])
    assert values(archives.trips_of(june), "ride_id") == [("b",)]
    both = archives.trips_of(archives.read_archives(spark, str(tmp_path), more=("battery_level",)))
    assert values(both, "ride_id", "battery_level") == [("a", "80"), ("b", None)]
    assert archives.read_archives(spark, str(tmp_path), [202401]).count() == 0
    assert archives.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_members_of_many_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "CHUNK_ROWS", 100)
    pack(tmp_path, "202505", {"a.csv": HEADER + "".join(ride(str(i)) for i in range(1050))})
    rows = archives.trips_of(archives.read_archives(spark, str(tmp_path)))
    assert rows.select("ride_id").distinct().count() == 1050


def test_archives_that_arrive_late_or_anew_are_merged_once(spark, tmp_path):
    landing, root, checkpoint = tmp_path / "landing", str(tmp_path / "root"), str(tmp_path / "state")
    landing.mkdir()

    def run():
        archives.merge_archives(spark, str(landing), root, checkpoint).awaitTermination()
        return values(raw_table(spark, root, "trips"), "ride_id", "member_casual")

    pack(landing, "202506", {"a.csv": HEADER + ride("june"), "b.csv": HEADER + ride("bad") * 9})
    spoil(landing, "202506", b"bad", b"BAD")
    assert run() == [("june", "member")]
    assert [r.member for r in spark.read.parquet(f"{root}/damage/archives").collect()] == ["b.csv"]
    pack(landing, "202505", {"a.csv": HEADER + ride("may")})  # an earlier month, later
    assert run() == [("june", "member"), ("may", "member")]
    pack(landing, "202506", {"a.csv": HEADER + ride("june", "casual"), "b.csv": HEADER + ride("bad")})
    assert run() == [("bad", "member"), ("june", "casual"), ("may", "member")]
    assert run() == [("bad", "member"), ("june", "casual"), ("may", "member")]


def test_csv_splits_over_tasks_unless_a_break_stands_within_quotes(spark, tmp_path):
    plain, quoted = tmp_path / "202505-citibike-tripdata.csv", tmp_path / "202506-citibike-tripdata.csv"
    rows = [ride(f'"a ""b"", {i}"') for i in range(3000)]
    plain.write_text(HEADER + "".join(rows))
    quoted.write_text(HEADER + "".join(rows) + ride('"two\nlines"'))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        may, _ = trips.load_bike_csv(spark, str(tmp_path), 2025, [5])
        june, _ = trips.load_bike_csv(spark, str(tmp_path), 2025, [6])
        assert may.rdd.getNumPartitions() > 5 and june.rdd.getNumPartitions() == 1
        assert may.count() == 3000 and june.count() == 3001
        assert june.exceptAll(may).select("ride_id").first()[0] == "two\nlines"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
