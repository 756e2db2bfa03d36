"""Keyed merge and incremental refresh."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citytrips.functions import floor_hour
from citytrips.operators.dedup import keep_first


#: Keys of a batch that may be broadcast, some megabytes.
FEW_KEYS = 100_000


def without_keys_of(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                    few: bool = False) -> DataFrame:
    """Rows of target whose key does not occur in batch; a null matches a null.

    Keys are sent through the driver to all tasks only where the caller knows them to be
    ``few``. Spark would judge by the files' size, and keys that compress well take ten
    times that in memory.
    """
    gone = batch.select(*[F.col(k).alias(f"_{k}") for k in keys])
    gone = F.broadcast(gone) if few else gone.hint("merge")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return target.join(gone, same, "left_anti")


def with_keys_of(target: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of target with one of a few keys, which are broadcast; a null matches a null."""
    wanted = few.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return target.join(F.broadcast(wanted), same, "left_semi")


def merge_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: rows of the batch replace rows of target with the same key.

    Columns only one side has are filled with null, so merging the same batch twice, or a
    batch with a new column, needs no preparation.
    """
    latest = keep_first(batch, keys)
    return without_keys_of(target, latest, keys).unionByName(latest, allowMissingColumns=True)


def sync_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Bring target to the columns of batch: drop the gone ones, add new ones as null."""
    return target.select(*[
        (F.col(f.name) if f.name in target.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in batch.schema.fields
    ])


def replace_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Delete the keys of batch from target, then insert batch with its schema."""
    kept = without_keys_of(target, batch, [key])
    return sync_schema(kept, batch).unionByName(batch)


def latest(target: DataFrame | None, column: str):
    """Largest value of a time column; None for a missing or empty table.

    In a table of months only the last month is read, which Parquet footers tell.
    """
    if target is None:
        return None
    if "pickup_month" in target.columns:
        month = target.agg(F.max("pickup_month")).first()[0]
        target = target.filter(F.col("pickup_month") == month)
    return target.agg(F.max(column)).first()[0]


def _newer(df: DataFrame, value: Column, mark, start: str | None) -> DataFrame:
    if start is not None:
        return df.filter(value >= F.lit(start).cast("timestamp_ntz"))
    if mark is None:
        return df
    return df.filter(value > F.lit(mark))


def new_trips(trips: DataFrame, target: DataFrame | None, start: str | None = None,
              lookback_minutes: int = 0) -> DataFrame:
    """Trips to process: later than the latest in target, or from a backfill date on.

    The mark is strict, so rows that arrive late for an earlier time are passed over unless
    a lookback re-reads some minutes before it. A missing or empty target passes all rows.
    The mark is read first and applied as a literal, which reaches the scan.
    """
    mark = None if start is not None else latest(target, "pickup_datetime")
    if mark is not None:
        mark -= timedelta(minutes=lookback_minutes)
    return _newer(trips, F.col("pickup_datetime"), mark, start)


def new_hours(fct: DataFrame, target: DataFrame | None, start: str | None = None) -> DataFrame:
    """Trips of hours later than the last hour in target, or from a backfill date on.

    An hour that is already in target is not computed again.
    """
    mark = None if start is not None else latest(target, "hour_timestamp")
    picked = _newer(fct, floor_hour(F.col("pickup_datetime")), mark, start)
    # The same bound on the plain column lets the scan skip files.
    return _newer(picked, F.col("pickup_datetime"), mark, start)
