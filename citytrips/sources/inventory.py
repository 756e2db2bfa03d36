"""Sizes of landed source files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citytrips import rules
from citytrips.functions import percent


def file_inventory(spark: SparkSession, path: str, pattern: str = "*",
                   deviation_pct: float = rules.FILE_DEVIATION_PCT,
                   small_mb: float = rules.FILE_SMALL_MB) -> DataFrame:
    """Size and age of each file, its deviation from the mean size, and warnings.

    File contents are not read: the content column is pruned from the scan. The window
    covers one row per file of the folder.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(path)
        .select("path", "modificationTime", (F.col("length") / 1048576.0).alias("size_mb"))
    )
    everything = Window.partitionBy()
    size, mean = F.col("size_mb"), F.col("avg_size_mb")
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "size_mb",
        F.col("modificationTime").alias("last_modified"),
        F.avg(size).over(everything).alias("avg_size_mb"),
        F.min(size).over(everything).alias("min_size_mb"),
        F.max(size).over(everything).alias("max_size_mb"),
    ).withColumns({
        "pct_from_avg": percent(size - mean, mean),
        "is_deviating": F.abs(percent(size - mean, mean)) > deviation_pct,
        "is_suspicious": size < small_mb,
    })
