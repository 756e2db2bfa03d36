"""Column expressions shared by all operators. Built-in functions only, no UDFs."""

from citytrips.functions.keys import surrogate_key
from citytrips.functions.labels import (
    band, by_hour, by_member, compass, hour_in, human_number, none_text, title_label,
)
from citytrips.functions.numbers import (
    c_to_f, divide, percent, round_half_away, speed_mph, whole,
)
from citytrips.functions.time import (
    calendar, day_of_week, floor_day, floor_hour, floor_month, iso_date, minute_diff, month_key,
    series_of_days,
)

__all__ = [
    "band", "by_hour", "by_member", "c_to_f", "calendar", "compass", "day_of_week", "divide",
    "floor_day", "floor_hour", "floor_month", "hour_in", "human_number", "iso_date", "minute_diff",
    "month_key", "none_text", "percent", "round_half_away", "series_of_days", "speed_mph",
    "surrogate_key", "title_label", "whole",
]
