"""Missing days in a time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citytrips.functions import floor_month, series_of_days


def days_present(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Distinct days with at least one row."""
    return df.select(F.to_date(ts).alias("actual_date")).filter(
        "actual_date is not null").distinct()


def expected_days(present: DataFrame) -> DataFrame:
    """Every day between the first and the last day present."""
    return present.agg(F.min("actual_date").alias("a"), F.max("actual_date").alias("b")).select(
        F.explode(series_of_days(F.col("a"), F.col("b"))).alias("expected_date")
    )


def missing_dates(df: DataFrame, ts: str = "pickup_datetime", start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """Days without rows, between the first and last day present or in a given inclusive range."""
    if start is not None and end is not None:
        bounds = [F.lit(x).cast("date") for x in (start, end)]
        from_start, to_end = (b.cast("timestamp_ntz") for b in (bounds[0], F.date_add(bounds[1], 1)))
        df = df.filter((F.col(ts) >= from_start) & (F.col(ts) < to_end))
        expected = df.sparkSession.range(1).select(
            F.explode(series_of_days(*bounds)).alias("expected_date")
        )
        present = days_present(df, ts)
    else:
        present = days_present(df, ts)
        expected = expected_days(present)
    return expected.join(
        present, F.col("expected_date") == F.col("actual_date"), "left_anti"
    )


def _ranges(runs: DataFrame, min_days: int) -> DataFrame:
    return (
        runs.groupBy("_run")
        .agg(
            F.min("expected_date").alias("gap_start"),
            F.max("expected_date").alias("gap_end"),
            F.count(F.lit(1)).alias("days_missing"),
        )
        .filter(F.col("days_missing") >= min_days)
        .drop("_run")
        .orderBy("gap_start")
    )


def missing_ranges(df: DataFrame, ts: str = "pickup_datetime", min_days: int = 1,
                   **bounds: str) -> DataFrame:
    """Consecutive missing days merged into ranges of at least min_days.

    A run starts where the previous missing day is not the day before. The window sees
    missing days only, at most one row per calendar day, whatever the size of df.
    """
    in_order = Window.orderBy("expected_date")
    day = F.col("expected_date")
    starts = F.coalesce((F.datediff(day, F.lag(day).over(in_order)) > 1).cast("int"), F.lit(0))
    runs = missing_dates(df, ts, **bounds).withColumn("_starts", starts)
    return _ranges(runs.withColumn("_run", F.sum("_starts").over(in_order)), min_days)


def spine_gaps(df: DataFrame, ts: str = "pickup_datetime", min_days: int = 1) -> DataFrame:
    """The same ranges from the whole spine: missing days between two present days share the
    number of present days so far. One row per calendar day passes the window.
    """
    present = days_present(df, ts)
    spine = expected_days(present).join(
        present, F.col("expected_date") == F.col("actual_date"), "left"
    )
    seen = F.count("actual_date").over(Window.orderBy("expected_date"))
    return _ranges(spine.withColumn("_run", seen).filter("actual_date is null"), min_days)


def month_coverage(df: DataFrame, ts: str = "started_at", since: str | None = None) -> DataFrame:
    """First day, last day, days with rows and rows of every month."""
    if since is not None:
        df = df.filter(F.col(ts) >= F.lit(since).cast("timestamp_ntz"))
    # Rows are counted per day first, so the distinct days need no second pass over df.
    daily = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return (
        daily.groupBy(floor_month(F.col("day")).alias("month"))
        .agg(
            F.min("day").alias("first_date"),
            F.max("day").alias("last_date"),
            F.count(F.lit(1)).alias("days_with_data"),
            F.sum("n").alias("total_trips"),
        )
        .orderBy("month")
    )


def month_edge_gaps(df: DataFrame, ts: str = "started_at", since: str | None = None) -> DataFrame:
    """Days missing at the start and the end of each month.

    ``edge_day`` is the day of month data starts or ends on; ``recurring`` tells whether all
    gaps of that side share it. A month without a gap has one row of type ``complete``.
    """
    months = month_coverage(df, ts, since)
    first, last = F.trunc("first_date", "month"), F.last_day("last_date")

    def gap(kind: str, a: Column, b: Column, edge: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("gap_type"), a.alias("gap_start"), b.alias("gap_end"),
            (F.datediff(b, a) + 1).alias("days_missing"), edge.alias("edge_day"),
        )

    opens, closes = F.col("first_date"), F.col("last_date")
    none = F.lit(None)
    sides = F.array(
        F.when(opens > first, gap("start", first, F.date_sub(opens, 1), F.dayofmonth(opens))),
        F.when(closes < last, gap("end", F.date_add(closes, 1), last, F.dayofmonth(closes))),
        F.when((opens == first) & (closes == last), F.struct(
            F.lit("complete").alias("gap_type"), none.cast("date").alias("gap_start"),
            none.cast("date").alias("gap_end"), F.lit(0).alias("days_missing"),
            none.cast("int").alias("edge_day"),
        )),
    )
    rows = months.select("month", F.inline(F.filter(sides, lambda s: s.isNotNull())))
    side = Window.partitionBy("gap_type")
    same = F.min("edge_day").over(side) == F.max("edge_day").over(side)
    return rows.withColumn("recurring", F.coalesce(same, F.lit(False)))


def missing_estimate(df: DataFrame, ts: str = "started_at", since: str | None = None,
                     share: float | None = None, min_days: int | None = None) -> DataFrame:
    """Trips presumably missing from incomplete months.

    A month is complete when it starts on day 1 and has enough days; each other month is
    assumed to lack a fixed share of the mean complete month.
    """
    from citytrips import rules

    share = rules.MISSING_MONTH_SHARE if share is None else share
    min_days = rules.MONTH_DAYS_MINIMUM if min_days is None else min_days
    months = month_coverage(df, ts, since)
    complete = (F.dayofmonth("first_date") == 1) & (F.col("days_with_data") >= min_days)
    stats = months.agg(
        F.count(F.when(complete, 1)).alias("complete_months"),
        F.count(F.when(~complete, 1)).alias("incomplete_months"),
        F.avg(F.when(complete, F.col("total_trips"))).alias("avg_complete_month"),
        F.sum("total_trips").alias("total_trips"),
    )
    missing = F.col("avg_complete_month") * share * F.col("incomplete_months")
    return stats.withColumn("estimated_missing", missing).withColumn(
        "potential_total", F.col("total_trips") + F.col("estimated_missing")
    )
