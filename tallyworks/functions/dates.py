"""Date helpers. Every function takes the as-of date as an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str | Column) -> Column:
    """A date literal from a ``date``, ISO text or column."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def parse_yyyymmdd(col: Column) -> Column:
    """Digit text to a date; NULL for text that is no date, such as ``00000000``."""
    return F.try_to_date(col, "yyyyMMdd")


def digits_to_time(col: Column) -> Column:
    """``HHmmss`` digits to ``HH:mm:ss`` text; NULL for anything else."""
    valid = col.rlike("^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]$")
    return F.when(valid, F.concat_ws(":", F.substring(col, 1, 2), F.substring(col, 3, 2), F.substring(col, 5, 2)))


def month_key(col: Column) -> Column:
    """``year/month`` text, month without a leading zero."""
    return F.concat(F.year(col).cast("string"), F.lit("/"), F.month(col).cast("string"))


def in_month(col: Column, as_of: dt.date | str | Column, offset: int = 0) -> Column:
    """True when ``col`` lies in the month of ``as_of`` moved by ``offset`` months.

    A half-open date range rather than a formatted key, so it can reach the scan.
    """
    start = F.add_months(F.trunc(as_date(as_of), "MM"), offset)
    return (col >= start) & (col < F.add_months(start, 1))


def ageing_days(col: Column, as_of: dt.date | str | Column) -> Column:
    return F.datediff(as_date(as_of), col)


def ageing_bucket(days: Column) -> Column:
    """Bucket label for an age in days; '' when the age is NULL."""
    return (
        F.when(days < 30, "Current")
        .when(days == 30, "Over 30 Days")
        .when(days <= 59, "31-59 Days")
        .when(days <= 90, "60-90 Days*")
        .when(days > 90, "Over 91 Days*")
        .otherwise("")
    )


def digits_between(col: Column, start: dt.date, end: dt.date) -> Column:
    """Digit-text date inside ``[start, end]``.

    The text range alone decides for well-formed values and reaches the file scan; the
    parse check drops text that merely sorts into the range.
    """
    low, high = start.strftime("%Y%m%d"), end.strftime("%Y%m%d")
    return col.between(low, high) & parse_yyyymmdd(col).isNotNull()


def month_bounds(as_of: dt.date, offset: int = 0) -> tuple[dt.date, dt.date]:
    """First and last day of the month of ``as_of`` moved by ``offset`` months."""
    index = as_of.year * 12 + as_of.month - 1 + offset
    first = dt.date(index // 12, index % 12 + 1, 1)
    following = dt.date((index + 1) // 12, (index + 1) % 12 + 1, 1)
    return first, following - dt.timedelta(days=1)
