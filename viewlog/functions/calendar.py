"""Date expressions. None of them reads the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_day(text: Column | str) -> Column:
    """``yyyyMMdd`` first, then any date text Spark understands; NULL instead of an error."""
    text = col(text).cast("string")
    return F.coalesce(F.try_to_date(text, "yyyyMMdd"), F.try_to_date(text))


def date_key(day: Column | str) -> Column:
    """2024-01-16 as the integer 20240116."""
    day = col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_name(day: Column | str) -> Column:
    return F.date_format(col(day), "MMMM")


def day_name(day: Column | str) -> Column:
    return F.date_format(col(day), "EEEE")


def is_weekend(day: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0 (day numbers run 1 = Sunday to 7 = Saturday)."""
    return F.dayofweek(col(day)).isin(1, 7).cast("int")


def days_inclusive(first: Column | str, last: Column | str) -> Column:
    """Number of calendar days from ``first`` to ``last``, both counted."""
    return F.datediff(col(last), col(first)) + 1


def day_from_name(name: Column | str) -> Column:
    """The first run of eight digits in a file or folder name, '' when there is none."""
    return F.regexp_extract(col(name), r"(\d{8})", 1)


def with_calendar_columns(rows: DataFrame, day: str = "DateValue") -> DataFrame:
    """Add the calendar columns of a date, computed rather than joined in."""
    return rows.withColumns({
        "DateKey": date_key(day),
        "Year": F.year(day),
        "Quarter": F.quarter(day),
        "Month": F.month(day),
        "MonthName": month_name(day),
        "Day": F.dayofmonth(day),
    })
