"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(app: str = "citytrips", **extra: str) -> SparkSession:
    """A session with the settings this library is tuned for."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables, unique to this application.

    A cluster names its folder in ``spark.checkpoint.dir``; where that is unset, the session's
    warehouse is used, which executors share too. Never a folder of one machine's own choice.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{configured.rstrip('/')}/citytrips/{spark.sparkContext.applicationId}"


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of queries that have ended.

    It deletes those whose plans its driver has collected as garbage, which a driver that only plans
    does seldom, so the files of all queries of a long step would lie on disk together. Files that a
    running task may still read are left alone, unlike with Spark's setting to delete them at a query's end.
    """
    gc.collect()
    spark._jvm.System.gc()
