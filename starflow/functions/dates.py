"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: the extracts count arrival days from this date.
DAY_NUMBER_EPOCH = "1960-01-01"


def from_day_number(days: Column | str, epoch: str = DAY_NUMBER_EPOCH) -> Column:
    """Day number (a double in the extracts) -> date.

    ``try_cast`` to int first: ``date_add`` rejects doubles on Spark 4, and
    NaN / null / out-of-range day numbers become a null date instead of
    failing the job under ANSI mode.
    """
    return F.date_add(F.lit(epoch).cast("date"), as_col(days).try_cast("int"))


def to_date_col(c: Column | str, fmt: str | None = None) -> Column:
    """string/timestamp -> date; unparseable text gives null instead of failing under ANSI mode."""
    c = as_col(c)
    return F.try_to_date(c, fmt) if fmt else c.try_cast("date")


def date_key(d: Column | str) -> Column:
    """Date -> int ``yyyyMMdd`` by arithmetic (no string round trip); null stays null."""
    d = as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week0(d: Column | str) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark's ``dayofweek`` is 1-based)."""
    return F.dayofweek(as_col(d)) - 1


def iso_week(d: Column | str) -> Column:
    """ISO-8601 week of year (2016-01-01 is week 53)."""
    return F.weekofyear(as_col(d))


def date_columns(d: Column | str) -> dict[str, Column]:
    """The dimension columns of ``dim_date`` for a date column."""
    d = as_col(d)
    return {
        "date_id": date_key(d),
        "year": F.year(d).cast("short"),
        "month": F.month(d).cast("short"),
        "day": F.dayofmonth(d).cast("short"),
        "day_of_week": day_of_week0(d).cast("short"),
        "week_of_year": iso_week(d).cast("short"),
    }
