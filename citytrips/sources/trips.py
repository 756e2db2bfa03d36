"""Readers of landed monthly trip files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytrips import schemas
from citytrips.sources.columns import conform, normalize_columns, snake_case, union_months
from citytrips.sources.months import validate_months
from citytrips.sources.report import Entry
from citytrips.sources.tables import exists, qualified

YELLOW_FILE = "yellow_tripdata_{year}-{month:02d}.parquet"
FHV_FILE = "fhv_tripdata_{year}-{month:02d}.parquet"
BIKE_ZIP = "{year}{month:02d}-citibike-tripdata.zip"
BIKE_CSV = "{year}{month:02d}-citibike-tripdata.csv"
CSV_CHUNK_ROWS = 50_000

Loaded = tuple[DataFrame | None, list[Entry]]


def _path(root: str, pattern: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/{pattern.format(year=year, month=month)}"


def _reason(error: Exception) -> str:
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return condition or f"{type(error).__name__}: {error}"


def _together(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Months as one scan whose schema has the columns of all of them."""
    frame = spark.read.option("mergeSchema", "true").parquet(*paths)
    return conform(normalize_columns(frame), schema, extra=True)


def load_parquet_months(spark: SparkSession, root: str, year: int, months: Sequence[int],
                        pattern: str, source: str, schema: T.StructType) -> Loaded:
    """Read the months that exist; one that cannot be read is reported and left out.

    Usually all months become one scan. Where a file is damaged or a column changed its type,
    each month is opened on its own, which tells what fails and casts each type by itself.
    """
    paths = {m: _path(root, pattern, year, m) for m in validate_months(months)}
    present = {m: p for m, p in paths.items() if exists(spark, p)}
    problems = {m: "PATH_NOT_FOUND" for m in paths if m not in present}
    frame = None
    if present:
        try:
            frame = _together(spark, list(present.values()), schema)
        except Exception:  # noqa: BLE001 - found out month by month below
            frames = []
            for month, path in present.items():
                try:
                    frames.append(_together(spark, [path], schema))
                except Exception as error:  # noqa: BLE001 - recorded for this month
                    problems[month] = _reason(error)
            frame = union_months(frames) if frames else None
    entries = [
        Entry(year, m, source, "failed" if m in problems else "success", problems.get(m))
        for m in paths
    ]
    return frame, entries


def load_yellow(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> Loaded:
    return load_parquet_months(
        spark, root, year, months, YELLOW_FILE, "yellow_taxi", schemas.RAW_YELLOW)


def load_fhv(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> Loaded:
    return load_parquet_months(spark, root, year, months, FHV_FILE, "fhv_taxi", schemas.RAW_FHV)


def _required(loaded: Loaded) -> DataFrame:
    frame, entries = loaded
    if frame is None:
        raise FileNotFoundError("; ".join(f"{e.year}-{e.month:02d}: {e.error}" for e in entries))
    return frame


def read_yellow(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> DataFrame:
    """Yellow-taxi months as one frame; missing months are skipped."""
    return _required(load_yellow(spark, root, year, months))


def read_fhv(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> DataFrame:
    """For-hire months as one frame; missing months are skipped."""
    return _required(load_fhv(spark, root, year, months))


def _members(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """CSV members of zip archives with their header line, or the error of a bad archive.

    Reads central directories and first lines only.
    """

    def listing(batches: Iterator) -> Iterator:
        import csv
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path, month in zip(batch["path"], batch["month"]):
                try:
                    files, name = fs.FileSystem.from_uri(path)
                    with zipfile.ZipFile(files.open_input_file(name)) as archive:
                        inside = archive.namelist()
                        if not inside:
                            raise zipfile.BadZipFile("archive is empty")
                        for member in inside:
                            if not member.endswith(".csv"):
                                continue
                            with archive.open(member) as stream:
                                text = io.TextIOWrapper(stream, "utf-8-sig")
                                header = next(csv.reader(text), [])
                            rows.append((path, month, member, header, None))
                except Exception as error:  # noqa: BLE001 - any damage fails this month only
                    rows.append((path, month, None, None, f"{type(error).__name__}: {error}"))
            names = ["path", "month", "member", "header", "error"]
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return paths.mapInPandas(
        listing, "path string, month int, member string, header array<string>, error string"
    )


def _zip_rows(spark: SparkSession, members: Sequence[tuple[str, str]],
              names: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """Rows of CSV members as text columns, renamed by ``names``.

    One task per member, as a compressed member can only be read from its start; the task
    streams it in chunks, so memory does not grow with the member.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    chunk_rows, wanted = CSV_CHUNK_ROWS, list(columns)

    def rows(batches: Iterator) -> Iterator:
        import zipfile

        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            for path, member in zip(batch["path"], batch["member"]):
                files, name = fs.FileSystem.from_uri(path)
                with zipfile.ZipFile(files.open_input_file(name)) as archive:
                    with archive.open(member) as stream:
                        # Only empty fields are null, as in unpacked files.
                        for chunk in pd.read_csv(stream, chunksize=chunk_rows, dtype=object,
                                                 encoding="utf-8-sig", keep_default_na=False,
                                                 na_values=[""]):
                            renamed = chunk.rename(columns=names)
                            yield renamed.reindex(columns=wanted).astype(object)

    listed = spark.createDataFrame(list(members), "path string, member string")
    return listed.repartition(max(1, len(members)), "path", "member").mapInPandas(rows, schema)


def _uri(spark: SparkSession, path: str) -> str:
    """The path with its file system, as tasks open it without Hadoop."""
    full = qualified(spark, path)
    if full.startswith("file:/") and not full.startswith("file://"):
        full = full.replace("file:", "file://", 1)
    return full.replace("s3a://", "s3://", 1)


def load_bike_zips(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> Loaded:
    """Read monthly zip archives, all CSV members of each.

    The driver handles archive and member names and header lines only.
    """
    months = validate_months(months)
    paths = [(_uri(spark, _path(root, BIKE_ZIP, year, m)), m) for m in months]
    listed = spark.createDataFrame(paths, "path string, month int").repartition(len(paths), "path")
    found = _members(spark, listed).collect()
    bad = {r["month"]: r["error"] for r in found if r["error"]}
    good = [r for r in found if not r["error"] and r["month"] not in bad]
    with_data = {r["month"] for r in good}
    entries = [
        Entry(year, m, "trips", "failed" if m in bad or m not in with_data else "success",
              bad.get(m) or (None if m in with_data else "no CSV member"))
        for m in months
    ]
    if not good:
        return None, entries
    declared = schemas.RAW_BIKE.fieldNames()
    names = {c: snake_case(c.strip()) for r in good for c in r["header"]}
    columns = declared + sorted(set(names.values()) - set(declared))
    frame = _zip_rows(spark, [(r["path"], r["member"]) for r in good], names, columns)
    return conform(frame, schemas.RAW_BIKE, extra=True), entries


def breaks_within_quotes(lines: DataFrame) -> Column:
    """Whether a text file may hold a line break within quotes, as an aggregate over its lines.

    A field that goes on in the next line leaves its line with an odd number of quotes, as quotes
    within quotes are doubled. A stray quote also counts, which costs speed but no rows.
    """
    quotes = F.length(lines["value"]) - F.length(F.replace(lines["value"], F.lit('"'), F.lit("")))
    return F.max(quotes % 2 == 1)


def load_bike_csv(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> Loaded:
    """Read unpacked monthly CSV. Spark splits a file over tasks, unlike archives, except where line
    breaks stand within quotes: a split reader would take these for ends of rows, so such a month is
    read by one task a file. One scan of the lines, split over tasks, finds these months.
    """
    paths = {m: _path(root, BIKE_CSV, year, m) for m in validate_months(months)}
    lines = [spark.read.text(p).select("value", F.lit(m).alias("month"))
             for m, p in paths.items() if exists(spark, p)]
    broken: dict[int, bool] = {}
    if lines:
        found = reduce(DataFrame.unionAll, lines)
        broken = dict(found.groupBy("month").agg(breaks_within_quotes(found)).collect())
    frames, entries = [], []
    for month, path in paths.items():
        try:
            # A quote within quotes is doubled.
            frame = spark.read.options(
                header="true", escape='"', multiLine=bool(broken.get(month))).csv(path)
            frames.append(conform(normalize_columns(frame), schemas.RAW_BIKE, extra=True))
            entries.append(Entry(year, month, "trips", "success", None))
        except PySparkException as error:
            entries.append(Entry(year, month, "trips", "failed", _reason(error)))
    return (union_months(frames) if frames else None), entries


def load_bike(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> Loaded:
    """Bike months: the unpacked CSV where it lies beside the archive, else the archive."""
    frame, entries = load_bike_csv(spark, root, year, months)
    absent = [e.month for e in entries if e.status == "failed"]
    if not absent:
        return frame, entries
    zipped, zip_entries = load_bike_zips(spark, root, year, absent)
    kept = [e for e in entries if e.status == "success"] + zip_entries
    frames = [f for f in (frame, zipped) if f is not None]
    return (union_months(frames) if frames else None), sorted(kept, key=lambda e: e.month)


def read_bike(spark: SparkSession, root: str, year: int, months: Sequence[int]) -> DataFrame:
    """Bike months as one frame; missing months are skipped."""
    return _required(load_bike(spark, root, year, months))
