"""Interval labels for a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERVALS = ("daily", "weekly", "monthly", "yearly", "overall")


def interval_label(date: Column | str, interval: str, year_qualified: bool = False) -> Column:
    """Label a date with its interval.

    Weeks and months are plain numbers (ISO week, month), so the same week of two
    years falls together.  ``year_qualified`` uses the first day of the week or
    month instead.
    """
    date = F.col(date) if isinstance(date, str) else date
    if interval == "daily":
        return date
    if interval == "weekly":
        if year_qualified:
            return F.date_trunc("week", date).cast("date")
        return F.weekofyear(date)
    if interval == "monthly":
        if year_qualified:
            return F.date_trunc("month", date).cast("date")
        return F.month(date)
    if interval == "yearly":
        return F.year(date)
    if interval == "overall":
        return F.lit("OVERALL")
    raise ValueError(f"unknown interval {interval!r}, expected one of {INTERVALS}")
