"""Numeric casts and averages that do not depend on row order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketmill.functions.text import as_column

MONEY = "decimal(10,2)"


def rounded_int(col: Column | str) -> Column:
    """Integer cast that rounds half to even, where Spark's own cast cuts off.

    Integer columns with gaps arrive as `45.0`, so text goes through double first.
    """
    return F.bround(as_column(col).cast("double")).cast("int")


def money(col: Column | str) -> Column:
    return as_column(col).cast(MONEY)


def smallest_units(col: Column | str, scale: int) -> Column:
    """A decimal as a whole number, such as cents. A sum of these is one plain field of a
    shuffled row, one of decimals three."""
    return (as_column(col) * F.lit(10**scale)).cast("bigint")


def of_units(col: Column | str, scale: int) -> Column:
    """Whole units as a decimal again, exactly."""
    unit = F.lit(Decimal(1).scaleb(-scale))
    return as_column(col).cast("decimal(20,0)") * unit


def mean_of(total: Column, count: Column) -> Column:
    """Average from an exact decimal total: one rounding, NULL for no rows."""
    return F.try_divide(total.cast("double"), count)


def or_zero(col: Column | str, kind: str) -> Column:
    """`col`, or a zero of the same type where a left join found nothing."""
    return F.coalesce(as_column(col), F.lit(0).cast(kind))
