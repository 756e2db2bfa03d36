"""Micro-batch merge of raw trips, and hourly counts and exact medians by mode over event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from citytrips import schemas
from citytrips.functions import month_key
from citytrips.sources.ingest import merge_raw
from citytrips.sources.tables import MONTH, merge_into, stage


def read_stream(spark: SparkSession, folder: str, schema: T.StructType,
                files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def merge_stream(spark: SparkSession, landing: str, root: str, table: str, checkpoint: str,
                 files_per_batch: int | None = None) -> StreamingQuery:
    """Merge arriving files of one raw table by its key; returns the started query.

    The merge is idempotent, so a batch repeated after a failure changes nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            merge_raw(spark, root, table, batch)

    stream = read_stream(spark, landing, schemas.RAW[table], files_per_batch)
    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


HOURLY_KEYS = ("hour_timestamp", "trip_type")


def hourly_counts(trips: DataFrame, late: str = "2 hours") -> DataFrame:
    """Counts, sums and means per tumbling hour and mode; exact medians are ``hourly_medians``.

    State is one row per open hour and mode; the watermark drops hours that have closed.
    A watermark needs a zoned column, so run this in a session with a zone without clock
    changes, such as UTC.
    """
    zoned = trips.withColumn("event_time", F.col("pickup_datetime").cast("timestamp"))
    return (
        zoned.withWatermark("event_time", late)
        .groupBy(F.window("event_time", "1 hour").alias("w"), "trip_type")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.sum("revenue").alias("total_revenue"),
            F.avg("trip_distance").alias("avg_trip_distance_miles"),
        )
        .select(F.col("w.start").cast("timestamp_ntz").alias("hour_timestamp"), "trip_type",
                "trip_count", "total_revenue", "avg_trip_distance_miles")
    )


def hourly_stream(spark: SparkSession, landing: str, path: str, checkpoint: str,
                  schema: T.StructType, late: str = "2 hours",
                  files_per_batch: int | None = None,
                  state_partitions: int = 16) -> StreamingQuery:
    """Keep a table of hourly counts up to date from arriving files of unified trips.

    Trips are combined in the map tasks, so few rows per hour and mode reach the state. It
    gets its own small number of partitions, which the first run of a checkpoint fixes.
    """
    session = _state_session(spark, state_partitions)
    counts = hourly_counts(read_stream(session, landing, schema, files_per_batch), late)
    return _upsert_hours(spark, counts, "update", path, checkpoint)


def _state_session(spark: SparkSession, partitions: int, **settings: str) -> SparkSession:
    session = spark.newSession()
    for name, value in {"spark.sql.shuffle.partitions": str(partitions),
                        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
                        **settings}.items():
        session.conf.set(name, value)
    return session


def _upsert_hours(spark: SparkSession, hours: DataFrame, mode: str, path: str,
                  checkpoint: str) -> StreamingQuery:
    """Keep a table of hours and modes; a batch repeated after a failure changes nothing."""

    def upsert(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        monthly = batch.withColumn(MONTH, month_key(F.col("hour_timestamp")))
        # Landed, as the merge reads it several times.
        merge_into(spark, path, stage(monthly, f"{checkpoint}-batch"), HOURLY_KEYS)

    return (
        hours.writeStream.outputMode(mode).foreachBatch(upsert)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


class OpenHours(StatefulProcessor):
    """Value counts of the open hours of each mode; an hour is given out once, when the watermark
    has passed its end, and then forgotten.

    The state of an hour is a list of (measure, values, rows): arrays of different values and how often
    each occurs. A batch appends one of each without reading the earlier ones, so the state
    grows with the different values of a batch, and calls with its hours only.
    """

    def __init__(self, measures: Sequence[str]):
        self.measures = list(measures)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getListState("value_counts", "measure string, vals binary, counts binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np

        trips, seen = 0, {measure: [] for measure in self.measures}
        for frame in rows:
            trips += len(frame)  # all trips, also those without a value
            for measure, parts in seen.items():
                values = frame[measure].to_numpy(dtype=float, na_value=np.nan)
                parts.append(np.unique(values[~np.isnan(values)] + 0.0, return_counts=True))
        held = [("", np.zeros(1), np.array([trips]))]
        held += [(measure, *_summed(parts)) for measure, parts in seen.items()]
        self.handle.registerTimer(key[0] + 3_600_000)  # again changes nothing
        self.counts.appendList([
            (m, v.astype("<f8").tobytes(), n.astype("<i8").tobytes()) for m, v, n in held if len(v)])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import numpy as np
        import pandas as pd

        held = {measure: [] for measure in ["", *self.measures]}
        for measure, values, counts in self.counts.get():
            held[measure].append((np.frombuffer(values, "<f8"), np.frombuffer(counts, "<i8")))
        row = {"hour_ms": key[0], "trip_type": key[1], "trip_count": int(_summed(held[""])[1].sum())}
        row |= {measure: _middle(*_summed(held[measure])) for measure in self.measures}
        self.counts.clear()
        yield pd.DataFrame([row])

    def close(self) -> None:
        pass


def _summed(parts: list) -> tuple:
    """Different values in ascending order, with their rows added up, of several such pairs."""
    import numpy as np

    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.empty(0), np.empty(0, dtype="<i8")
    values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    counts = np.zeros(len(values), dtype="<i8")
    np.add.at(counts, at, np.concatenate([n for _, n in parts]))
    return values, counts


def _middle(values, counts) -> float | None:
    """Median of ascending values that occur so often."""
    import numpy as np

    if not len(values):
        return None
    upto = np.cumsum(counts)
    last = int(upto[-1]) - 1
    low, high = (float(values[np.searchsorted(upto, place, side="right")])
                 for place in (last // 2, (last + 1) // 2))
    return low * 0.5 + high * 0.5


def hourly_medians(trips: DataFrame, measures: Sequence[str], late: str = "2 hours") -> DataFrame:
    """Exact medians and counts of every closed hour and mode, each given out once.

    A trip whose time lies behind the watermark is left out, one that is late by less counts in full.
    Needs the RocksDB state store and, as ``hourly_counts``, a zone without clock changes.
    """
    values = [F.col(m).cast("double").alias(m) for m in measures]
    zoned = trips.select(F.col("pickup_datetime").cast("timestamp").alias("event_time"), "trip_type", *values)
    hour = F.unix_millis(F.date_trunc("hour", "event_time")).alias("hour_ms")
    medians = ", ".join(f"`{m}` double" for m in measures)
    closed = zoned.withWatermark("event_time", late).withColumn("hour_ms", hour).groupBy(
        "hour_ms", "trip_type").transformWithStateInPandas(
        OpenHours(measures), f"hour_ms bigint, trip_type string, trip_count bigint, {medians}",
        "Append", "EventTime")
    return closed.select(
        F.timestamp_millis("hour_ms").cast("timestamp_ntz").alias("hour_timestamp"), "trip_type",
        "trip_count", *[F.col(m).alias(f"median_{m}") for m in measures])


def median_stream(spark: SparkSession, landing: str, path: str, checkpoint: str,
                  schema: T.StructType, measures: Sequence[str], late: str = "2 hours",
                  files_per_batch: int | None = None, state_partitions: int = 16) -> StreamingQuery:
    """Keep a table of exact medians of closed hours from arriving files of unified trips.

    The open hours are kept in the checkpoint, so a stream that is started again goes on with them.
    """
    session = _state_session(spark, state_partitions, **{
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    medians = hourly_medians(read_stream(session, landing, schema, files_per_batch), measures, late)
    return _upsert_hours(spark, medians, "append", path, checkpoint)
