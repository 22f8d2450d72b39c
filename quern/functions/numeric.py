"""Numbers: exact money sums, integer rules, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def cents(value: Column) -> Column:
    """A DOUBLE amount with two decimals as a whole number of cents."""
    return F.rint(value * F.lit(100.0)).cast("bigint")


def cents_to_amount(total: Column) -> Column:
    """A sum of cents as DECIMAL(28,2)."""
    return (total.cast("decimal(28,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(
        "decimal(28,2)"
    )


def sum_amount(value: Column) -> Column:
    """Exact sum of a two-decimal DOUBLE column, whatever the order of addition.

    Cents are added as BIGINT, which stays in generated code; an overflow raises.
    """
    return cents_to_amount(F.sum(cents(value)))


def average_amount(value: Column) -> Column:
    """Average of a two-decimal DOUBLE column from exact sums."""
    # Without any value there is no average, rather than a division by zero.
    return F.sum(cents(value)) / F.nullif(F.count(value) * F.lit(100), F.lit(0))


def whole_quotient(left: Column, right: Column) -> Column:
    """Division of integers that drops the remainder, e.g. 7 / 2 = 3."""
    return F.call_function("div", left, right)


def whole_average(value: Column) -> Column:
    """Average of an integer column with the fraction dropped."""
    return whole_quotient(F.sum(value), F.nullif(F.count(value), F.lit(0)))


def rounded_int(value: Column) -> Column:
    """An amount as INT, rounded half away from zero rather than cut off."""
    return F.round(value, 0).cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """A quotient of counts as DECIMAL(18,8), never integer division."""
    return (part.cast("decimal(18,0)") / whole.cast("decimal(18,0)")).cast(
        "decimal(18,8)"
    )
