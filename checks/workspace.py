"""Tables the registered queries share, built once per session and input folder."""

from __future__ import annotations

import hashlib
from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips import fixtures
from citytrips.fixtures import ProjectedStore
from citytrips.operators.dims import dim_date, dim_location, dim_time, dim_weather, time_spine
from citytrips.operators.staging import (
    stg_bike, stg_fhv, stg_weather, stg_yellow, trips_unioned,
)
from citytrips.plans import metrics, pipeline, rollups
from citytrips.session import shared_folder
from citytrips.sources.tables import stage


class Workspace:
    """Raw and staged frames are lazy; facts and dimensions are written tables, as they
    would be in use, so that each report scans the fact instead of deriving it again."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        name = hashlib.md5(self.folder.encode()).hexdigest()[:12]
        self.root = f"{shared_folder(spark)}/{name}"
        self.store = ProjectedStore(spark, self.root, self.folder)
        self._runs = 0

    def scratch(self, name: str) -> str:
        """A folder nothing was written to before."""
        self._runs += 1
        return f"{self.root}/scratch/{name}-{self._runs}"

    def raw(self, name: str) -> DataFrame:
        return self.store.raw(name)

    def stg_yellow(self, wide: bool = True) -> DataFrame:
        return stg_yellow(self.raw("yellow_taxi"), fixtures.MIN_PICKUP, wide)

    def stg_fhv(self, wide: bool = True) -> DataFrame:
        return stg_fhv(self.raw("fhv_taxi"), fixtures.MIN_PICKUP, wide)

    def stg_bike(self) -> DataFrame:
        return stg_bike(self.raw("trips"))

    def stg_weather(self) -> DataFrame:
        return stg_weather(self.raw("hourly_weather"))

    def trips(self) -> DataFrame:
        return trips_unioned(
            yellow=self.stg_yellow(False), fhv=self.stg_fhv(False), bike=self.stg_bike())

    def dim_weather(self) -> DataFrame:
        return dim_weather(self.stg_weather())

    def dim_location(self) -> DataFrame:
        return dim_location(self.store.zones())

    def dim_date(self) -> DataFrame:
        return dim_date(self.trips())

    def dim_time(self) -> DataFrame:
        return dim_time(self.spark)

    @cached_property
    def _built(self) -> bool:
        pipeline.build(self.store, self.store.zones())
        return True

    def table(self, name: str) -> DataFrame:
        assert self._built
        return self.store.table(name)

    @property
    def fct(self) -> DataFrame:
        return self.table("fct_trips")

    @property
    def hourly(self) -> DataFrame:
        return self.table("fct_hourly_mobility")

    @property
    def dates(self) -> DataFrame:
        return self.table("dim_date")

    @property
    def hours(self) -> DataFrame:
        return self.table("dim_time")

    @property
    def zones(self) -> DataFrame:
        return self.table("dim_location")

    @property
    def weather(self) -> DataFrame:
        return self.table("dim_weather")

    def spine(self) -> DataFrame:
        """Days between the first and the last day of the calendar, a one-row lookup."""
        day = F.col("date_key").cast("date")
        first, last = self.dates.agg(F.min(day), F.max(day)).first()
        return time_spine(self.spark, str(first), str(last + timedelta(days=1)))

    @cached_property
    def rollups(self) -> dict[rollups.Rollup, DataFrame]:
        """Kept states of the trips: hours from the fact, days and months from the hours."""
        hours = stage(rollups.build(metrics.TRIPS, self.fct, rollups.TRIP_HOURS), self.scratch("hours"))
        kept = {rollups.TRIP_HOURS: hours}
        for coarse in (rollups.TRIP_MONTHS, rollups.MODE_DAYS):
            kept[coarse] = stage(rollups.derive(
                metrics.TRIPS, hours, rollups.TRIP_HOURS, coarse), self.scratch(coarse.grain))
        return kept

    def semantic_tables(self) -> dict[str, DataFrame]:
        return {
            "fct_trips": self.fct, "fct_hourly_mobility": self.hourly, "date": self.dates,
            "time": self.hours, "location": self.zones,
            "spine": self.spine(),
        }


_WORKSPACES: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _WORKSPACES:
        _WORKSPACES[key] = Workspace(spark, folder)
    return _WORKSPACES[key]
