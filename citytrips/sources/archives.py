"""Monthly zip archives of bike trips as a Spark data source, read whole or as they arrive.

One partition per CSV member. A member is read to its end once before its rows are given out, so
its checksum and its lines are known to be right; a damaged one becomes a single row that says so, and others keep their rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from citytrips import schemas
from citytrips.sources.columns import conform, snake_case
from citytrips.sources.ingest import merge_raw
from citytrips.sources.report import Entry, report_frame
from citytrips.sources.tables import qualified, stage

NAME = "bike_archives"
CHUNK_ROWS = 50_000
ARCHIVE = re.compile(r"(?:^|/)(\d{4})(\d{2})-citibike-tripdata\.zip$")
# Beside the columns of the members: where a row comes from, and what is wrong with its member.
PLACE = T.StructType([
    T.StructField("archive_month", T.IntegerType()), T.StructField("member", T.StringType()),
    T.StructField("error", T.StringType()),
])


def text_schema(columns: T.StructType = schemas.RAW_BIKE, *more: str) -> T.StructType:
    """The place of a row, then its columns as text; ``more`` names columns beyond the declared ones."""
    names = [*columns.fieldNames(), *more]
    return T.StructType([*PLACE.fields, *[T.StructField(n, T.StringType()) for n in names]])


class Member(InputPartition):
    """One CSV member of an archive, or an archive whose list of members cannot be read."""

    def __init__(self, path: str, month: int, member: str | None, error: str | None = None):
        super().__init__(path)
        self.path, self.month, self.member, self.error = path, month, member, error


def _listed(folder: str) -> dict[str, str]:
    """Archives of a folder by path, each with its size and time of change."""
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(folder)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return {f.path: f"{f.size}-{f.mtime_ns}" for f in found
            if f.type == fs.FileType.File and ARCHIVE.search(f.path)}


def _members(folder: str, paths: list[str]) -> list[Member]:
    """Partitions of archives, from their central directories."""
    import zipfile

    from pyarrow import fs

    files, _ = fs.FileSystem.from_uri(folder)
    out = []
    for path in sorted(paths):
        year, month = ARCHIVE.search(path).groups()
        number = int(year) * 100 + int(month)
        try:
            with zipfile.ZipFile(files.open_input_file(path)) as archive:
                names = [n for n in archive.namelist() if n.endswith(".csv")]
            problem = None if names else "no CSV member"
        except Exception as error:  # noqa: BLE001 - any damage fails this archive only
            names, problem = [], f"{type(error).__name__}: {error}"
        out += [Member(path, number, n) for n in names] or [Member(path, number, None, problem)]
    return out


def _batches(folder: str, schema: T.StructType, part: Member) -> Iterator:
    """Rows of a member as Arrow batches of the schema."""
    import zipfile

    import pandas as pd
    import pyarrow as pa
    from pyarrow import fs

    fields = [(f.name, pa.int32() if f.dataType == T.IntegerType() else pa.string())
              for f in schema.fields]
    shape = pa.schema(fields)

    def failure(error: str) -> pa.RecordBatch:
        row = {"archive_month": part.month, "member": part.member, "error": error}
        return pa.RecordBatch.from_pylist([{n: row.get(n) for n in shape.names}], schema=shape)

    if part.error:
        yield failure(part.error)
        return
    try:
        files, _ = fs.FileSystem.from_uri(folder)
        with zipfile.ZipFile(files.open_input_file(part.path)) as archive:
            with archive.open(part.member) as stream:
                for _ in _frames(pd, stream):  # the checksum is compared at the end
                    pass
    except Exception as error:  # noqa: BLE001 - becomes the row of this member
        yield failure(f"{type(error).__name__}: {error}")
        return
    with zipfile.ZipFile(files.open_input_file(part.path)) as archive:
        with archive.open(part.member) as stream:
            for chunk in _frames(pd, stream):
                named = chunk.rename(columns=lambda c: snake_case(c.strip()))
                named = named.reindex(columns=shape.names)
                named["archive_month"], named["member"], named["error"] = part.month, part.member, None
                yield from pa.Table.from_pandas(
                    named, schema=shape, preserve_index=False).to_batches()


def _frames(pd, stream) -> Iterator:
    # Only empty fields are null, as in unpacked files. A member without any line has no rows.
    try:
        yield from pd.read_csv(stream, chunksize=CHUNK_ROWS, dtype=object, encoding="utf-8-sig",
                               keep_default_na=False, na_values=[""])
    except pd.errors.EmptyDataError:
        return


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, schema: T.StructType, months: str | None):
        self.folder, self.schema = folder, schema
        self.months = {int(m) for m in months.split(",")} if months else None

    def partitions(self) -> list[Member]:
        parts = _members(self.folder, list(_listed(self.folder)))
        wanted = [p for p in parts if self.months is None or p.month in self.months]
        return wanted or [Member("", 0, None)]

    def read(self, partition: Member) -> Iterator:
        return _batches(self.folder, self.schema, partition) if partition.path else iter(())


class ArchiveStream(DataSourceStreamReader):
    """Archives as they arrive. The offset holds every archive seen with its size and time, a few
    characters a month, so an earlier month that arrives late is read, as is one published anew."""

    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.schema = folder, schema

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return _listed(self.folder)

    def partitions(self, start: dict, end: dict) -> list[Member]:
        return _members(self.folder, [p for p, state in end.items() if start.get(p) != state])

    def read(self, partition: Member) -> Iterator:
        return _batches(self.folder, self.schema, partition)


class BikeArchives(DataSource):
    """Options: ``path``, a folder that holds ``YYYYMM-citibike-tripdata.zip`` files; ``months``,
    the months (yyyymm, separated by commas) a batch read is for, all by default."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return text_schema()

    def reader(self, schema: T.StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"], schema, self.options.get("months"))

    def streamReader(self, schema: T.StructType) -> ArchiveStream:
        return ArchiveStream(self.options["path"], schema)


def folder_uri(spark: SparkSession, path: str) -> str:
    """The folder with its file system, as Python tasks open it."""
    full = qualified(spark, path)
    if full.startswith("file:/") and not full.startswith("file://"):
        full = full.replace("file:", "file://", 1)
    return full.replace("s3a://", "s3://", 1).rstrip("/")


def read_archives(spark: SparkSession, path: str, months: list[int] | None = None,
                  more: tuple[str, ...] = ()) -> DataFrame:
    """Rows of all archives of a folder, or of some months (yyyymm), and one row per damaged member.

    ``more`` names columns of the members beyond the declared ones.
    """
    spark.dataSource.register(BikeArchives)
    reader = spark.read.format(NAME).schema(text_schema(schemas.RAW_BIKE, *more))
    if months:
        reader = reader.option("months", ",".join(map(str, months)))
    return reader.load(folder_uri(spark, path))


def trips_of(rows: DataFrame) -> DataFrame:
    """The trips among the rows of archives, in the declared types."""
    return conform(rows.filter("error is null").drop(*PLACE.fieldNames()), schemas.RAW_BIKE, extra=True)


def damage_of(rows: DataFrame) -> DataFrame:
    """Damaged members, one row each."""
    return rows.filter("error is not null").select(*PLACE.fieldNames())


def archive_report(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """One entry per month and state of its members, as for other sources. Rows are counted in the
    map tasks; one row per month reaches the driver."""
    found = rows.groupBy("archive_month").agg(
        F.count(F.when(F.col("error").isNull(), 1)).alias("rows"), F.max("error").alias("error"))
    return report_frame(spark, [
        Entry(r["archive_month"] // 100, r["archive_month"] % 100, "trips",
              "failed" if r["error"] else "success", r["error"])._replace(rows=r["rows"])
        for r in found.orderBy("archive_month").collect()])


def merge_archives(spark: SparkSession, landing: str, root: str, checkpoint: str) -> StreamingQuery:
    """Merge archives that have arrived into the raw bike trips; damaged members go to a table.

    The merge is by key and a batch's damage replaces that of an earlier try of it, so a batch
    repeated after a failure changes nothing.
    """
    spark.dataSource.register(BikeArchives)
    stream = spark.readStream.format(NAME).schema(text_schema()).load(folder_uri(spark, landing))

    def merge(batch: DataFrame, number: int) -> None:
        rows = stage(batch, f"{root}/staging/archives")
        damage_of(rows).write.mode("overwrite").parquet(f"{root}/damage/archives/batch={number}")
        merge_raw(spark, root, "trips", trips_of(rows))

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
