"""Time expressions on zone-less timestamps.

``date_trunc`` and ``unix_seconds`` take zoned timestamps, so on a zone-less column they
convert through the session time zone and can shift hours around clock changes. These
expressions use calendar parts only and give the same result in every session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_day(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz")


def floor_hour(ts: Column) -> Column:
    return floor_day(ts) + F.make_dt_interval(hours=F.hour(ts))


def floor_month(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month").cast("timestamp_ntz")


def month_key(ts: Column) -> Column:
    """Calendar month as yyyymm, the partition column of the large tables."""
    return F.year(ts) * 100 + F.month(ts)


def iso_date(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(ts) - 1


def minute_diff(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end; negative when end comes first."""

    def of_day(ts: Column) -> Column:
        return F.hour(ts) * 60 + F.minute(ts)

    days = F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return days * 1440 + (of_day(end) - of_day(start))


def series_of_days(first: Column, last: Column) -> Column:
    """Array of all dates from first to last, both included."""
    return F.sequence(first, last, F.make_dt_interval(days=F.lit(1)))


def calendar(d: Column) -> dict[str, Column]:
    """Attributes of a date, by column name."""
    month, day, dow = F.month(d), F.dayofmonth(d), day_of_week(d)
    ends_month = d == F.last_day(d)
    weekend = dow.isin(0, 6)
    return {
        "date_key": d.cast("string"),
        "date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": month,
        "month_name": F.date_format(d, "MMMM"),
        "month_name_short": F.date_format(d, "MMM"),
        "week_of_year": F.weekofyear(d),
        # ISO weeks restart around New Year, so this can be negative in January.
        "week_of_month": F.weekofyear(d) - F.weekofyear(F.trunc(d, "month")) + 1,
        "day_of_month": day,
        "day_of_week": dow,
        "day_name": F.date_format(d, "EEEE"),
        "day_name_short": F.date_format(d, "EEE"),
        "day_of_year": F.dayofyear(d),
        "is_weekend": weekend,
        "is_weekday": ~weekend,
        "is_month_start": day == 1,
        "is_month_end": ends_month,
        "is_quarter_start": (day == 1) & (month % 3 == 1),
        "is_quarter_end": ends_month & (month % 3 == 0),
        "is_year_start": F.dayofyear(d) == 1,
        "is_year_end": ends_month & (month == 12),
    }
