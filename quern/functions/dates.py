"""Dates: month-first literals and pushable ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def us_date(text: str) -> Column:
    """A month-first date literal such as ``4/1/2005`` as TIMESTAMP_NTZ.

    It is read once on the driver, so the filter that uses it can be pushed down.
    """
    return F.lit(datetime.strptime(text, "%m/%d/%Y")).cast("timestamp_ntz")


def month_bounds(year: int, month: int) -> tuple[Column, Column]:
    """First instant of a month and of the next one."""
    following = (year + month // 12, month % 12 + 1)
    first, after = datetime(year, month, 1), datetime(*following, 1)
    return (
        F.lit(first).cast("timestamp_ntz"),
        F.lit(after).cast("timestamp_ntz"),
    )


def in_month(moment: Column, year: int, month: int) -> Column:
    """Half-open range on the bare column, so row groups can be skipped."""
    first, after = month_bounds(year, month)
    return (moment >= first) & (moment < after)
