"""Zone-free helpers on dates and timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(start, end) -> Column:
    """Seconds from start to end as a double, whatever the session zone."""
    diff = _col(end) - _col(start)
    return diff.cast("interval second").cast("decimal(20,6)").cast("double")


def minutes_between(start, end) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def day(c) -> Column:
    return F.to_date(_col(c))


def month_key(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def month_start(c) -> Column:
    return F.trunc(F.to_date(_col(c)), "month")


def in_year(c, year: int) -> Column:
    """Whether a date or timestamp lies in a year, as a range that file readers can skip by."""
    c = _col(c)
    return (c >= F.lit(f"{year}-01-01").cast("date")) & (c < F.lit(f"{year + 1}-01-01").cast("date"))


def in_month(c, month: str) -> Column:
    """Whether a date or timestamp lies in a month given as ``yyyy-MM``, as a range."""
    c, (year, number) = _col(c), map(int, month.split("-"))
    after = f"{year + number // 12}-{number % 12 + 1:02d}-01"
    return (c >= F.lit(f"{month}-01").cast("date")) & (c < F.lit(after).cast("date"))


def hour_start(c) -> Column:
    """Start of the hour, kept without a zone."""
    c = _col(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def is_weekend(c) -> Column:
    return F.weekday(_col(c)) >= 5


# Hours counted as rush hours.
RUSH_HOURS = (7, 8, 9, 17, 18, 19)


def is_rush_hour(c) -> Column:
    return F.hour(_col(c)).isin(*RUSH_HOURS)


def as_number(c, dtype: str) -> Column:
    """A double that sorts like the value: numbers, dates and timestamps."""
    c = _col(c)
    if dtype == "date":
        return F.date_diff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if dtype == "timestamp_ntz":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (c - epoch).cast("interval second").cast("decimal(20,6)").cast("double")
    if dtype == "timestamp":
        return F.unix_micros(c).cast("double")
    return c.cast("double")
