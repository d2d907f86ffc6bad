"""Numeric and text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(f"`{col}`") if isinstance(col, str) else col


def non_negative(col: str | Column) -> Column:
    """Null and negative values become 0."""
    return F.greatest(F.lit(0.0), F.coalesce(_c(col).cast("double"), F.lit(0.0)))


def floor_zero(col: str | Column) -> Column:
    """Negative values become 0; null stays null (``greatest`` alone would drop it)."""
    c = _c(col)
    return F.when(c < 0, F.lit(0).cast("double")).otherwise(c)


def shipping_days(ship: str | Column, order: str | Column) -> Column:
    """Whole days from order to shipment, never below 0; null when not shipped."""
    gap = F.datediff(_c(ship), _c(order))
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0)))


def margin(profit: str | Column, sales: str | Column) -> Column:
    """Profit over sales where there are sales, else null."""
    return F.when(_c(sales) > 0, _c(profit) / _c(sales))


def share(part: str | Column, whole: str | Column) -> Column:
    """Part over whole, 0 where the whole is not positive."""
    return F.when(_c(whole) > 0, _c(part) / _c(whole)).otherwise(F.lit(0.0))


def decade(year: str | Column) -> Column:
    """``1990s`` for 1990 to 1999."""
    return F.concat((F.floor(_c(year) / 10) * 10).cast("string"), F.lit("s"))


def release_date(year: str | Column) -> Column:
    return F.make_date(_c(year), F.lit(1), F.lit(1))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (null counts as not holding)."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def label_prefix(col: str | Column) -> Column:
    """The text before a bracketed suffix."""
    return F.split_part(_c(col), F.lit(" ("), F.lit(1))


def money_text(col: str | Column) -> Column:
    """``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(_c(col), 2))


def percent_text(col: str | Column) -> Column:
    """``12.34%`` from a fraction."""
    return F.format_string("%.2f%%", _c(col).cast("double") * 100)
