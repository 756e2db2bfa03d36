"""What an ingestion did, month by month."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Entry(NamedTuple):
    year: int
    month: int
    source: str
    status: str
    error: str | None
    rows: int | None = None


REPORT_SCHEMA = "year int, month int, source string, status string, error string, rows bigint"


def report_frame(spark: SparkSession, entries: Sequence[Entry]) -> DataFrame:
    """The entries as a DataFrame, a few rows per month."""
    return spark.createDataFrame([tuple(e) for e in entries], REPORT_SCHEMA)
