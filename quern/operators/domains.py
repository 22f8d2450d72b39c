"""Declared domains of columns, used to answer predicates without a scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Interval:
    """Values between two bounds; None leaves a side open."""

    low: Any = None
    high: Any = None
    low_closed: bool = True
    high_closed: bool = True

    def meet(self, other: Interval) -> Interval:
        """Values that lie in both."""
        low, low_closed = self.low, self.low_closed
        if other.low is not None and (low is None or other.low > low):
            low, low_closed = other.low, other.low_closed
        elif other.low is not None and other.low == low:
            low_closed = low_closed and other.low_closed
        high, high_closed = self.high, self.high_closed
        if other.high is not None and (high is None or other.high < high):
            high, high_closed = other.high, other.high_closed
        elif other.high is not None and other.high == high:
            high_closed = high_closed and other.high_closed
        return Interval(low, high, low_closed, high_closed)

    @property
    def empty(self) -> bool:
        if self.low is None or self.high is None:
            return False
        if self.low == self.high:
            return not (self.low_closed and self.high_closed)
        return self.low > self.high

    def holds(self, other: Interval) -> bool:
        """Whether every value of ``other`` lies in this one."""
        return other.empty or self.meet(other) == other

    def predicate(self, column: Column) -> Column:
        """True for values inside, NULL for NULL."""
        parts = []
        if self.low is not None:
            parts.append(column >= F.lit(self.low) if self.low_closed else column > F.lit(self.low))
        if self.high is not None:
            parts.append(column <= F.lit(self.high) if self.high_closed else column < F.lit(self.high))
        return reduce(lambda a, b: a & b, parts) if parts else column.isNotNull()


def exactly(value: Any) -> Interval:
    return Interval(value, value)


def between(low: Any, high: Any) -> Interval:
    return Interval(low, high)


class DomainError(ValueError):
    """Rows lie outside a declared domain."""


class Domains:
    """Declared intervals of a table's columns, as its CHECK constraints state them.

    A CHECK is not violated by NULL, so a domain says nothing about NULLs; a predicate on
    the column drops them.  Domains count only after ``verify`` or when the table's
    loader checks them.
    """

    def __init__(self, intervals: Mapping[str, Interval]):
        self.intervals = dict(intervals)

    def verify(self, df: DataFrame) -> Domains:
        """Refuse the domains if a row lies outside; one scan of the columns, no shuffle."""
        outside = {
            name: ~domain.predicate(F.col(name)) for name, domain in self.intervals.items()
        }
        counts = df.agg(*[F.count_if(o).alias(n) for n, o in outside.items()]).first()
        broken = {n: counts[n] for n in outside if counts[n]}
        if broken:
            raise DomainError(f"rows outside their domain: {broken}")
        return self

    def filter(self, df: DataFrame, wanted: Mapping[str, Interval | Sequence[Interval]]) -> DataFrame:
        """Rows that satisfy all intervals, by what the domains leave to check.

        An interval that misses the domain gives an empty relation: nothing is scanned.
        One that holds the whole domain only drops NULLs.  Anything else is an ordinary
        predicate on the bare column.
        """
        checks = []
        for name, asked in wanted.items():
            parts = [asked] if isinstance(asked, Interval) else list(asked)
            asked = reduce(Interval.meet, parts)
            domain = self.intervals.get(name, Interval())
            if asked.empty or asked.meet(domain).empty:
                return df.filter(F.lit(False))
            column = F.col(name)
            whole = name in self.intervals and asked.holds(domain)
            checks.append(column.isNotNull() if whole else asked.predicate(column))
        return df.filter(reduce(lambda a, b: a & b, checks)) if checks else df
