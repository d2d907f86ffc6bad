"""Calendar columns and period arithmetic (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _c(col: str | Column) -> Column:
    return F.col(f"`{col}`") if isinstance(col, str) else col


def calendar_columns(date: str | Column) -> dict[str, Column]:
    """The ten calendar features of a date, ready for ``withColumns``."""
    d = _c(date)
    return {
        "Year": F.year(d),
        "Month": F.month(d),
        "MonthName": month_name(d),
        "Quarter": F.quarter(d),
        "Day": F.dayofmonth(d),
        "DayOfWeek": F.weekday(d),
        "DayName": day_name(d),
        "WeekOfYear": F.weekofyear(d),
        "IsWeekend": F.weekday(d) >= 5,
        "YearMonth": year_month(d),
    }


def year_month(date: str | Column) -> Column:
    """``yyyy-MM`` text, put together from numbers: far cheaper per row than a date pattern."""
    d = _c(date)
    return F.concat(
        F.lpad(F.year(d).cast("string"), 4, "0"), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0")
    )


def month_name(date: str | Column) -> Column:
    """``Jan`` to ``Dec``, looked up in a constant array."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(_c(date)))


def day_name(date: str | Column) -> Column:
    """``Mon`` to ``Sun``, looked up in a constant array."""
    return F.element_at(F.array(*[F.lit(x) for x in DAY_NAMES]), F.weekday(_c(date)) + 1)


def day(date: str | Column) -> Column:
    return F.to_date(_c(date))


def month_start(date: str | Column) -> Column:
    """First day of the month."""
    return F.trunc(_c(date), "MM")


def next_month(date: str | Column, months: int | Column = 1) -> Column:
    """The date ``months`` later, snapped to the month start."""
    return F.add_months(month_start(date), months)


def closing_monday(date: str | Column) -> Column:
    """The Monday that closes the Tuesday-to-Monday week of ``date``."""
    return F.trunc(F.date_add(day(date), 6), "week")


def position_in(labels: list[str], col: str | Column) -> Column:
    """1-based position of a label in calendar order, 0 when it is not one."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), _c(col))
