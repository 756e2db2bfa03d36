"""Reader of the zone seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citytrips import schemas


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zones from a CSV file with a header."""
    return spark.read.schema(schemas.ZONES).option("header", "true").csv(path)
