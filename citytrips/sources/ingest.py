"""Load landed months of chosen sources into the raw tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citytrips import schemas
from citytrips.functions import month_key
from citytrips.operators.dedup import keep_first
from citytrips.sources.months import validate_months
from citytrips.sources.report import Entry, report_frame
from citytrips.sources.tables import MONTH, merge_into, read_table, stage
from citytrips.sources.trips import Loaded, load_bike, load_fhv, load_yellow
from citytrips.sources.weather import load_weather

# What a user may name → raw tables loaded for it.
SOURCES = {
    "yellow": ("yellow_taxi",),
    "fhv": ("fhv_taxi",),
    "taxi": ("yellow_taxi", "fhv_taxi"),
    "citibike": ("trips",),
    "weather": ("hourly_weather",),
}
DEFAULT_SOURCES = ("taxi", "citibike", "weather")

_LOADERS: dict[str, Callable[[SparkSession, str, int, Sequence[int]], Loaded]] = {
    "yellow_taxi": load_yellow,
    "fhv_taxi": load_fhv,
    "trips": load_bike,
    "hourly_weather": load_weather,
}


def select_tables(sources: Iterable[str] | str) -> list[str]:
    """Raw tables of the named sources, in loading order; unknown names are rejected."""
    names = [s.strip() for s in sources.split(",")] if isinstance(sources, str) else list(sources)
    unknown = [n for n in names if n not in SOURCES]
    if unknown or not names:
        raise ValueError(f"unknown sources {unknown}; choose from {sorted(SOURCES)}")
    chosen = {table for n in names for table in SOURCES[n]}
    return [table for table in _LOADERS if table in chosen]


def with_month(df: DataFrame, table: str) -> DataFrame:
    """Add the partition column of a raw table."""
    return df.withColumn(MONTH, month_key(F.col(schemas.EVENT_TIME[table])))


def merge_raw(spark: SparkSession, root: str, table: str, batch: DataFrame) -> None:
    """Upsert a batch into a raw table by its natural key.

    The batch is deduplicated once into a staging zone, as the merge reads it several times.
    """
    keys = schemas.KEYS[table]
    landed = stage(keep_first(with_month(batch, table), keys), f"{root}/staging/{table}")
    movable = None if schemas.EVENT_TIME[table] in keys else ()
    merge_into(spark, f"{root}/raw/{table}", landed, keys, movable)


def raw_table(spark: SparkSession, root: str, table: str,
              declared: bool = False) -> DataFrame | None:
    """A raw table: all columns any month has, or the declared ones without reading footers."""
    path = f"{root}/raw/{table}"
    if not declared:
        return read_table(spark, path, evolving=True)
    return read_table(spark, path, T.StructType(
        [*schemas.RAW[table].fields, T.StructField(MONTH, T.IntegerType())]))


def ingest(spark: SparkSession, landing: str, root: str, year: int, months: Sequence[int],
           sources: Iterable[str] | str = DEFAULT_SOURCES) -> DataFrame:
    """Merge landed months into the raw tables; returns the report.

    A month that is missing or damaged is reported, the others load. The tables do not
    depend on each other and load at the same time.
    """
    months, names = validate_months(months), select_tables(sources)
    with ThreadPoolExecutor(len(names)) as pool:
        found = list(pool.map(lambda t: _load_table(spark, landing, root, t, year, months), names))
    return report_frame(spark, [entry for entries in found for entry in entries])


def _load_table(spark: SparkSession, landing: str, root: str, table: str, year: int,
                months: Sequence[int]) -> list[Entry]:
    """Usually one merge for all months. Where it fails, a file may be damaged in its body, which
    no footer tells: then each month is merged on its own, and only the damaged ones fail."""
    frame, entries = _LOADERS[table](spark, landing, year, months)
    if frame is None:
        return entries
    try:
        merge_raw(spark, root, table, frame)
    except Exception as error:  # noqa: BLE001 - one source must not stop the others
        loaded = [e.month for e in entries if e.status == "success"]
        if len(loaded) == 1:
            problem = f"{type(error).__name__}: {error}"
            return [e._replace(status="failed", error=problem) if e.month in loaded else e
                    for e in entries]
        alone = {m: _load_table(spark, landing, root, table, year, [m])[0] for m in loaded}
        return [alone.get(e.month, e) for e in entries]
    return _with_rows(spark, root, table, entries)


def _with_rows(spark: SparkSession, root: str, table: str, entries: list[Entry]) -> list[Entry]:
    """Fill in the rows the table now has for each loaded month, from partition counts."""
    wanted = [e.year * 100 + e.month for e in entries if e.status == "success"]
    counts = dict(
        raw_table(spark, root, table, declared=True).filter(F.col(MONTH).isin(wanted))
        .groupBy(MONTH).count().collect()
    )
    return [
        e._replace(rows=counts.get(e.year * 100 + e.month, 0)) if e.status == "success" else e
        for e in entries
    ]
