"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int = 0) -> Column:
    """Round in binary floating point, halves away from zero.

    ``F.round`` goes through the decimal text of the double, so 1.005 gives 1.01; scaling
    in binary gives 1.0, which is what the results here must carry.
    """
    scale = float(10**digits)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale


def whole(x: Column) -> Column:
    """Double to integer, halves to the even neighbour (a plain cast truncates)."""
    return F.rint(x.cast("double")).cast("int")


def divide(a: Column, b: Column) -> Column:
    """Quotient as double, null when the divisor is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(part: Column, total: Column, digits: int | None = None) -> Column:
    share = F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double"))
    return share if digits is None else round_half_away(share, digits)


def c_to_f(celsius: Column) -> Column:
    """Fahrenheit with one digit."""
    return round_half_away(celsius * 9.0 / 5.0 + 32.0, 1)


def speed_mph(miles: Column, minutes: Column) -> Column:
    """Miles per hour; null without a distance or a positive duration."""
    return F.when(minutes > 0, miles / minutes * 60.0)
