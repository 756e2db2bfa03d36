"""Month lists and month bounds."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Iterable
from datetime import date


def validate_months(months: Iterable[int] | str) -> list[int]:
    """Months as ints from 1 to 12; accepts a list or text such as ``"1,2,12"``."""
    items = months.split(",") if isinstance(months, str) else list(months)
    try:
        numbers = [int(m) for m in items]
    except (TypeError, ValueError) as error:
        raise ValueError(f"months must be whole numbers: {items}") from error
    wrong = [m for m in numbers if not 1 <= m <= 12]
    if wrong or not numbers:
        raise ValueError(f"months must lie between 1 and 12: {items}")
    return numbers


def month_bounds(year: int, month: int) -> tuple[date, date]:
    """First and last date of a month."""
    return date(year, month, 1), date(year, month, monthrange(year, month)[1])
