"""Date and timestamp typing that never fails a job, and calendar period filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(c: Column | str) -> Column:
    """ISO text, date or timestamp to DATE; anything unreadable becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("date")


def as_instant(c: Column | str) -> Column:
    """ISO text or timestamp to TIMESTAMP; anything unreadable becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("timestamp")


def as_mail_instant(c: Column | str) -> Column:
    """ISO text or an RFC-822 date ("Tue, 02 Jan 2024 03:04:05 GMT") to TIMESTAMP.

    The weekday is cut off first: it carries no information and Spark's parser rejects it.
    """
    c = F.col(c) if isinstance(c, str) else c
    bare = F.regexp_replace(c, r"^[A-Za-z]{3}, ", "")
    return F.coalesce(
        c.try_cast("timestamp"), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z"))
    )


def month_of(c: Column | str) -> Column:
    return F.trunc(c, "month")


def quarter_of(c: Column | str) -> Column:
    return F.trunc(c, "quarter")


def day(d: date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def since_months(c: Column | str, as_of: date, months: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c >= F.add_months(day(as_of), -months)


def period_filter(c: Column | str, period: str, as_of: date, months: bool = False) -> Column:
    """Rows of a reporting period, relative to an explicit date.

    A column of months cannot be cut within a month: with ``months`` the two periods that are
    compared with each other, ytd and pytd, are the complete months before the one of the date.

    current_year    calendar year of the date (the default window)
    ytd / pytd      year start up to the date, this year / the same days last year
    this_quarter    calendar quarter of the date
    last_quarter    the three latest complete months
    last_12_months  twelve months back from the date, open ended
    """
    c = F.col(c) if isinstance(c, str) else c
    at = day(as_of)
    if months and period in ("ytd", "pytd"):
        this_month, back = F.trunc(at, "month"), 0 if period == "ytd" else -12
        return (c >= F.add_months(F.trunc(at, "year"), back)) & (c < F.add_months(this_month, back))
    year_start = F.trunc(day(as_of), "year")
    if period == "current_year":
        return (c >= year_start) & (c < F.add_months(year_start, 12))
    if period == "ytd":
        return (c >= year_start) & (c <= at)
    if period == "pytd":
        return (c >= F.add_months(year_start, -12)) & (c <= F.add_months(at, -12))
    if period == "this_quarter":
        start = F.trunc(at, "quarter")
        return (c >= start) & (c < F.add_months(start, 3))
    if period == "last_quarter":
        start = F.trunc(at, "month")
        return (c >= F.add_months(start, -3)) & (c < start)
    if period == "last_12_months":
        return since_months(c, as_of, 12)
    raise ValueError(f"unknown period: {period}")
