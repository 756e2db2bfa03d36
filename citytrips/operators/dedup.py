"""One row per natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row of every key in the given order.

    All remaining columns break ties, so the choice does not depend on partitioning.
    The rank filter lets Spark keep one row per key in each map task before the shuffle
    (WindowGroupLimit), so a key with a very large number of copies stays cheap.
    """
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest, F.col(keys[0]))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
