"""Weeks and year ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def week_start(c: Column) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(c.cast("date"), "week")


def iso_week(c: Column) -> Column:
    return F.weekofyear(c)


def in_years(c: Column, first: int, last: int) -> Column:
    """``first <= year(c) <= last`` as a date range, which Parquet scans can use."""
    return (c >= F.lit(dt.date(first, 1, 1))) & (c < F.lit(dt.date(last + 1, 1, 1)))


def between_dates(c: Column, first: str, last: str) -> Column:
    return c.between(F.lit(dt.date.fromisoformat(first)), F.lit(dt.date.fromisoformat(last)))
