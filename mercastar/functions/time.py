"""Dates and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROSECONDS = 86_400_000_000


def floor_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down: -14 hours is -1 day."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    # A remainder taken with pmod is never negative, so this division is exact.
    return ((micros - F.pmod(micros, F.lit(DAY_MICROSECONDS))) / DAY_MICROSECONDS).cast("int")


def date_key(moment: Column) -> Column:
    """`yyyyMMdd` as a number."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def month_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit(" Q"), quarter.cast("string"))


def month_index(year: Column, month: Column) -> Column:
    """Months on one scale, so that two of them can be subtracted."""
    return year * 12 + month - 1


def label_of_month_index(index: Column) -> Column:
    return month_label(F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"))


def as_timestamp(text: Column) -> Column:
    """Zone-free timestamp, NULL where the text is not one."""
    return text.try_cast("timestamp_ntz")


def timestamp_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
