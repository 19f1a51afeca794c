"""Dashboard and panel queries over the marts. ``as_of`` stands for the current date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import calendar, measures
from viewlog.operators import rows

Day = date | str

# Short column tags the dashboard and the details table use for the categories: fixed values.
TAGS = {"TruyenHinh": "TH", "PhimTruyen": "PT", "GiaiTri": "GT", "ThieuNhi": "TN", "TheThao": "TT"}


def _sum_hours(column: str):
    return measures.hours(F.sum(column))


def kpis(daily: DataFrame, as_of: Day, days: int = 7, include_boundary: bool = True) -> DataFrame:
    """Contract-days, device-days, seconds, hours and days of the trailing window; zeros when empty.

    Daily distinct counts are added up, so a contract active on five days counts five times.
    """
    window = rows.trailing(daily, as_of, days, include_boundary=include_boundary)
    seconds = measures.or_zero(F.sum("TotalDuration_All"))
    return window.agg(
        measures.or_zero(F.sum("TotalContracts")).alias("TotalContracts"),
        measures.or_zero(F.sum("TotalDevices")).alias("TotalDevices"),
        seconds.alias("TotalDuration"),
        measures.hours(seconds).alias("TotalDuration_Hours"),
        F.count("*").alias("DaysCount"),
    )


def daily_hours(daily: DataFrame, as_of: Day, days: int = 7, include_boundary: bool = True) -> DataFrame:
    """Contracts, devices and hours per day, oldest first."""
    return rows.trailing(daily, as_of, days, include_boundary=include_boundary).select(
        "DateValue", "TotalContracts", "TotalDevices",
        measures.hours("TotalDuration_All").alias("TotalDuration_Hours"),
    ).orderBy("DateValue")


def daily_table(daily: DataFrame, start: Day, end: Day) -> DataFrame:
    """Days of a range with month name and hours per category, newest first."""
    tagged = {f"Duration_{tag}_Hours": f"TotalDuration_{suffix}" for suffix, tag in TAGS.items()}
    tagged["Duration_Total_Hours"] = "TotalDuration_All"
    return rows.between(daily, start, end).select(
        "DateValue", "Year", "Month", calendar.month_name("DateValue").alias("MonthName"), "Day",
        "TotalContracts", "TotalDevices",
        *[measures.hours(column).alias(name) for name, column in tagged.items()],
    ).orderBy(F.desc("DateValue"))


def distribution(daily: DataFrame) -> DataFrame:
    """Total hours per category as (label, value) rows: one aggregation, then unpivoted."""
    names = [c.label for c in schema.CATEGORIES]
    sums = [_sum_hours(f"TotalDuration_{c.suffix}").alias(c.label) for c in schema.CATEGORIES]
    wide = daily.agg(*sums)
    return wide.unpivot([], [F.col(f"`{name}`") for name in names], "label", "value")


def distribution_of_range(daily: DataFrame, start: Day, end: Day) -> DataFrame:
    return distribution(rows.between(daily, start, end))


def distribution_trailing(daily: DataFrame, as_of: Day, days: int = 30, include_boundary: bool = False) -> DataFrame:
    return distribution(rows.trailing(daily, as_of, days, include_boundary=include_boundary))


def _top(grouped: DataFrame, measure: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest measure; equal ones in contract order."""
    return grouped.orderBy(F.desc(measure), "ContractID").limit(n)


def contract_leaderboard(analytics: DataFrame, as_of: Day, n: int = 10, days: int = 30) -> DataFrame:
    """Contracts with the most hours in the trailing window."""
    return leaderboard(rows.trailing(analytics, as_of, days), n)


def leaderboard(window: DataFrame, n: int = 10) -> DataFrame:
    """Contracts with the most hours among the given rows of the mart, or of rollups of it.

    The two text columns are the largest values in binary order, as the dashboard defines them.
    """
    grouped = window.groupBy("ContractID").agg(
        F.sum("TotalDevices").alias("TotalDevices"),
        _sum_hours("Duration_Total").alias("TotalDuration_Hours"),
        _sum_hours("Duration_TruyenHinh").alias("Duration_TH_Hours"),
        _sum_hours("Duration_PhimTruyen").alias("Duration_PT_Hours"),
        _sum_hours("Duration_GiaiTri").alias("Duration_GT_Hours"),
        F.max("MostWatchContentType").alias("MostWatchContentType"),
        _sum_hours("MostWatchDuration").alias("MostWatchDuration_Hours"),
        F.max("ActivationDays").alias("ActivationDays"),
        F.max("ActivationLevel").alias("ActivationLevel"),
    )
    return _top(grouped, "TotalDuration_Hours", n)


def head_of(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of a leaderboard, as drawn in its bar chart."""
    return _top(ranked.select("ContractID", "TotalDuration_Hours"), "TotalDuration_Hours", n)


def trend(by_type: DataFrame, as_of: Day, days: int = 30, include_boundary: bool = True) -> DataFrame:
    """Hours, sessions and contracts per day and category, in that order."""
    return rows.trailing(by_type, as_of, days, include_boundary=include_boundary).select(
        "DateValue", "ContentType", measures.hours("TotalDuration").alias("Duration_Hours"),
        "TotalSessions", "UniqueContracts",
    ).orderBy("DateValue", "ContentType")


def daily_duration(daily: DataFrame, as_of: Day, days: int = 30, include_boundary: bool = False) -> DataFrame:
    return rows.trailing(daily, as_of, days, include_boundary=include_boundary).select(
        F.col("DateValue").alias("time"), measures.hours("TotalDuration_All").alias("duration_hours"),
    ).orderBy("time")


def top_contracts(
    analytics: DataFrame, as_of: Day, n: int = 10, days: int = 30, include_boundary: bool = False
) -> DataFrame:
    window = rows.trailing(analytics, as_of, days, include_boundary=include_boundary)
    return _top(window.groupBy("ContractID").agg(_sum_hours("Duration_Total").alias("duration_hours")),
                "duration_hours", n)


def contract_series(
    analytics: DataFrame, as_of: Day, contract: str | None, days: int = 30, include_boundary: bool = False
) -> DataFrame:
    """Daily hours per category of one contract, or of each contract when none is chosen.

    The mart has one row per date and contract, so there are no duplicates to remove.
    """
    window = rows.trailing(analytics, as_of, days, include_boundary=include_boundary)
    return rows.of_contract(window, contract).select(
        F.col("DateValue").alias("time"), "ContractID",
        *[measures.hours(f"Duration_{c.suffix}").alias(c.suffix) for c in schema.CATEGORIES],
    ).orderBy("time", "ContractID")


def contract_details(
    analytics: DataFrame, as_of: Day, n: int = 20, days: int = 30, include_boundary: bool = False
) -> DataFrame:
    """Contracts with the most hours, with the hours of every category."""
    return details(rows.trailing(analytics, as_of, days, include_boundary=include_boundary), n)


def details(window: DataFrame, n: int = 20) -> DataFrame:
    """The same for the given rows of the mart, or of rollups of it."""
    grouped = window.groupBy("ContractID").agg(
        F.sum("TotalDevices").alias("TotalDevices"),
        _sum_hours("Duration_Total").alias("TotalDuration_Hours"),
        *[_sum_hours(f"Duration_{suffix}").alias(f"{tag}_Hours") for suffix, tag in TAGS.items()],
    )
    return _top(grouped, "TotalDuration_Hours", n)


def contract_list(analytics: DataFrame) -> DataFrame:
    return analytics.select("ContractID").distinct().orderBy("ContractID")


def type_comparison(by_type: DataFrame, as_of: Day, days: int = 30, include_boundary: bool = False) -> DataFrame:
    """Hours per category, largest first."""
    window = rows.trailing(by_type, as_of, days, include_boundary=include_boundary)
    return window.groupBy("ContentType").agg(_sum_hours("TotalDuration").alias("duration_hours")).orderBy(
        F.desc("duration_hours"), "ContentType")


def type_statistics(by_type: DataFrame, as_of: Day, days: int = 30, include_boundary: bool = False) -> DataFrame:
    """Hours, sessions, contract-days and average daily hours per category.

    The average is taken in whole seconds before it becomes hours.
    """
    window = rows.trailing(by_type, as_of, days, include_boundary=include_boundary)
    return window.groupBy("ContentType").agg(
        _sum_hours("TotalDuration").alias("TotalDuration_Hours"),
        F.sum("TotalSessions").alias("TotalSessions"),
        F.sum("UniqueContracts").alias("UniqueContracts"),
        measures.hours(measures.whole_average("TotalDuration")).alias("AvgDuration_Hours"),
    ).orderBy(F.desc("TotalDuration_Hours"), "ContentType")


def realtime_daily(daily: DataFrame, as_of: Day, include_boundary: bool = False) -> DataFrame:
    """Daily summary of the last 24 hours, newest first."""
    return rows.trailing(daily, as_of, 1, include_boundary=include_boundary).select(
        F.col("DateValue").alias("time"), "TotalContracts", "TotalDevices",
        measures.hours("TotalDuration_All").alias("Duration_Hours"),
    ).orderBy(F.desc("time"))


def realtime_types(by_type: DataFrame, as_of: Day, include_boundary: bool = False) -> DataFrame:
    """Hours per category of the last 24 hours, largest first."""
    window = rows.trailing(by_type, as_of, 1, include_boundary=include_boundary)
    return window.groupBy("ContentType").agg(_sum_hours("TotalDuration").alias("Duration_Hours")).orderBy(
        F.desc("Duration_Hours"), "ContentType")
