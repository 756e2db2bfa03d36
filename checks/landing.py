"""Landed source files, written from the projected raw tables for the reader queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.workspace import Workspace
from citytrips.functions import month_key
from citytrips.sources.archives import folder_uri
from citytrips.sources.tables import CSV_TIME
from citytrips.sources.weather import PAYLOAD_FIELDS

# Names the source files use; the reader turns them into snake case.
YELLOW_NAMES = {"vendor_id": "VendorID", "pu_location_id": "PULocationID",
                "do_location_id": "DOLocationID", "ratecode_id": "RatecodeID",
                "airport_fee": "Airport_fee"}
FHV_NAMES = {"p_ulocation_id": "PUlocationID", "d_olocation_id": "DOlocationID",
             "drop_off_datetime": "dropOff_datetime",
             "affiliated_base_number": "Affiliated_base_number"}


def _monthly(df: DataFrame, ts: str, folder: str, name: str, kind: str) -> None:
    """One folder per month, written by one job and then given the name of the source file."""
    _named(df.withColumn("m", month_key(F.col(ts))).hint("rebalance", F.col("m")), folder, name, kind)


def _named(df: DataFrame, folder: str, name: str, kind: str) -> None:
    """Write by the month in ``m`` and name each month's folder as the source file."""
    spark = df.sparkSession
    options = {"header": "true", "timestampNTZFormat": CSV_TIME} if kind == "csv" else {}
    df.write.partitionBy("m").options(**options).format(kind).save(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path(folder)):
        old = status.getPath()
        if old.getName().startswith("m="):
            year, month = old.getName()[2:6], old.getName()[6:8]
            files.rename(old, path(f"{folder}/{name.format(year=year, month=month)}"))


def months(w: Workspace, folder: str) -> dict[int, list[int]]:
    """Months of each year that have a landed file, by the names of the files."""
    path = w.spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(w.spark._jsc.hadoopConfiguration()).listStatus(path)
    out: dict[int, list[int]] = {}
    for status in listed:
        if found := re.search(r"(\d{4})-?(\d{2})", status.getPath().getName()):
            out.setdefault(int(found[1]), []).append(int(found[2]))
    return dict(sorted(out.items()))


def _once(w: Workspace, name: str, write) -> str:
    found = w.__dict__.setdefault("_landed", {})
    if name not in found:
        found[name] = w.scratch(f"landing-{name}")
        write(found[name])
    return found[name]


def yellow(w: Workspace) -> str:
    def write(folder: str) -> None:
        raw = w.raw("yellow_taxi").withColumnsRenamed(YELLOW_NAMES)
        _monthly(raw, "tpep_pickup_datetime", folder, "yellow_tripdata_{year}-{month}.parquet",
                 "parquet")

    return _once(w, "yellow", write)


def fhv(w: Workspace) -> str:
    def write(folder: str) -> None:
        raw = w.raw("fhv_taxi").withColumnsRenamed(FHV_NAMES)
        _monthly(raw, "pickup_datetime", folder, "fhv_tripdata_{year}-{month}.parquet", "parquet")

    return _once(w, "fhv", write)


def bike_csv(w: Workspace) -> str:
    return _once(w, "bike", lambda folder: _monthly(
        w.raw("trips"), "started_at", folder, "{year}{month}-citibike-tripdata.csv", "csv"))


def weather_json(w: Workspace) -> str:
    """One document per month: parallel arrays with at most as many items as hours."""
    return _once(w, "weather", lambda folder: _payloads(w).write.partitionBy("m").text(folder))


def _payloads(w: Workspace) -> DataFrame:
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm")
    rows = w.raw("hourly_weather").withColumn("m", month_key(F.col("timestamp"))).groupBy("m")
    arrays = rows.agg(F.sort_array(F.collect_list(F.struct(
        time.alias("time"),
        *[F.col(c).alias(f) for c, f in PAYLOAD_FIELDS.items() if c != "timestamp"],
    ))).alias("r"))
    hourly = F.struct(*[F.col("r")[f].alias(f) for f in PAYLOAD_FIELDS.values()])
    return arrays.select(F.to_json(F.struct(hourly.alias("hourly"))).alias("value"), "m")


WEATHER_NAME = "weather_{year}-{month}.json"


def refused_weather(w: Workspace) -> str:
    """Documents by month, some an error message and some without hours."""

    def write(folder: str) -> None:
        kind = F.col("m") % 5
        value = (F.when(kind == 0, '{"error": true}').when(kind == 1, '{"hourly": {"time": []}}')
                 .otherwise(F.col("value")))
        _named(_payloads(w).select(value.alias("value"), "m"), folder, WEATHER_NAME, "text")

    return _once(w, "refused", write)


def taxi_and_weather(w: Workspace, year: int) -> str:
    """Landed files of a year of both taxi sources and the weather, in one folder."""

    def write(folder: str) -> None:
        parts = {
            "yellow": (_of_year(w, "yellow_taxi", "tpep_pickup_datetime", year)
                       .withColumnsRenamed(YELLOW_NAMES), "yellow_tripdata_{year}-{month}.parquet", "parquet"),
            "fhv": (_of_year(w, "fhv_taxi", "pickup_datetime", year).withColumnsRenamed(FHV_NAMES),
                    "fhv_tripdata_{year}-{month}.parquet", "parquet"),
            "weather": (_payloads(w).filter(F.floor(F.col("m") / 100) == year), WEATHER_NAME, "text"),
        }
        path = w.spark._jvm.org.apache.hadoop.fs.Path
        files = path(folder).getFileSystem(w.spark._jsc.hadoopConfiguration())
        files.mkdirs(path(folder))
        for part, (df, name, kind) in parts.items():
            _named(df, f"{folder}-{part}", name, kind)
            for status in files.listStatus(path(f"{folder}-{part}")):
                found = status.getPath()
                if not found.getName().startswith("_"):
                    files.rename(found, path(f"{folder}/{found.getName()}"))

    return _once(w, f"all-{year}", write)


def _of_year(w: Workspace, table: str, ts: str, year: int) -> DataFrame:
    return w.raw(table).filter(F.year(ts) == year).withColumn("m", month_key(F.col(ts)))


def bike_archives(w: Workspace, spoilt: bool = False) -> str:
    """A zip archive per month, its members the parts of the month's CSV; one task per month.

    ``spoilt`` adds an archive for the month after the last one that is cut within its first member.
    """

    def write(folder: str) -> None:
        source = folder_uri(w.spark, bike_csv(w))
        path = w.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(w.spark._jsc.hadoopConfiguration()).mkdirs(path)
        names = [(y, m) for y, found in months(w, bike_csv(w)).items() for m in found]
        year, month = max(names)
        after = (year + month // 12, month % 12 + 1) if spoilt else None
        target = folder_uri(w.spark, folder)
        rows = [(f"{y}{m:02d}", f"{y}{m:02d}", False) for y, m in names]
        rows += [(f"{year}{month:02d}", f"{after[0]}{after[1]:02d}", True)] if after else []
        listed = w.spark.createDataFrame(rows, "source string, target string, cut boolean")
        done = listed.repartition(len(rows), "target").mapInPandas(_packer(source, target), "target string")
        assert done.count() == len(rows)

    return _once(w, f"archives-{spoilt}", write)


def _packer(source: str, target: str):
    def pack(batches):
        import io
        import shutil
        import zipfile

        from pyarrow import fs

        for batch in batches:
            for month, name, cut in batch.itertuples(index=False):
                files, root = fs.FileSystem.from_uri(source)
                _, out = fs.FileSystem.from_uri(target)
                parts = files.get_file_info(fs.FileSelector(f"{root}/{month}-citibike-tripdata.csv"))
                parts = sorted(p.path for p in parts if p.path.endswith(".csv"))
                with files.open_output_stream(f"{out}/{name}-citibike-tripdata.zip") as sink:
                    if cut:
                        with files.open_input_stream(parts[0]) as data:
                            held = io.BytesIO()
                            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                                archive.writestr("part.csv", data.read(100_000))
                        sink.write(held.getvalue()[:len(held.getvalue()) // 2])
                        continue
                    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                        for part in parts:
                            with files.open_input_stream(part) as data, archive.open(
                                    part.rsplit("/", 1)[1], "w") as member:
                                shutil.copyfileobj(data, member)
            yield batch[["target"]]

    return pack


def month_files(w: Workspace) -> str:
    """One text file per month with a line of seven bytes for each for-hire trip."""
    lines = w.raw("fhv_taxi").select(F.col("dispatching_base_num").alias("value"),
                                     month_key(F.col("pickup_datetime")).alias("m"))
    return _once(w, "sizes", lambda folder: lines.repartition("m").write.partitionBy("m").text(folder))


def zones_csv(w: Workspace) -> str:
    return _once(w, "zones", lambda folder: w.store.zones().write.option("header", "true").csv(
        folder))


