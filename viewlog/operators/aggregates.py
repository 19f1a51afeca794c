"""Aggregations of the warehouse, the marts and the checks.

Sums, counts, minima and maxima combine map-side before any shuffle, and a distinct count shuffles
on the counted value first, so one huge group is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import measures


def session_grain(rows: DataFrame) -> DataFrame:
    """Raw rows summed to one row per date, contract, device and application.

    Everything downstream of staging (dimensions, facts, the media report, the checks) can be
    computed from this much smaller table, so staging itself is scanned once.
    """
    return rows.groupBy("EventDate", "Contract", "Mac", "AppName").agg(
        F.sum("TotalDuration").alias("TotalDuration"), F.count("*").alias("SessionCount")
    )


def contract_days(rows: DataFrame, *by: str, kind: str, device: str, prefix: str, total: str) -> DataFrame:
    """Distinct devices, seconds per category and total seconds per group: one wide row each."""
    seconds = measures.or_zero("TotalDuration")
    sums = [
        F.sum(F.when(F.col(kind) == c.label, seconds).otherwise(0)).alias(f"{prefix}_{c.suffix}")
        for c in schema.ALL_CATEGORIES
    ]
    return rows.groupBy(*by).agg(
        F.countDistinct(device).alias("TotalDevices"), *sums, F.sum(seconds).alias(f"{prefix}_{total}")
    )


def media_report(rows: DataFrame) -> DataFrame:
    """Seconds and rows per date and application; NULL dates and applications are groups too."""
    return rows.groupBy(F.col("EventDate").alias("ReportDate"), "AppName").agg(
        F.sum("TotalDuration").alias("TotalDuration"), F.count("*").alias("TotalAccess")
    )


def merge_partials(*partials: DataFrame, by: list[str], measure: str) -> DataFrame:
    """Sums of separately aggregated parts, summed again. Right for sums, not for distinct counts."""
    parts = partials[0]
    for part in partials[1:]:
        parts = parts.unionByName(part)
    return parts.groupBy(*by).agg(F.sum(measure).alias(measure))


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """One-row frames of counts as one row with all their columns, without a cross join."""
    names = [name for row in single_rows for name in row.columns]
    long = None
    for row in single_rows:
        part = row.unpivot([], row.columns, "_name", "_value")
        long = part if long is None else long.unionByName(part)
    return long.agg(*[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in names])


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row counts of several tables as one row, one column per table."""
    return side_by_side(*[table.agg(F.count("*").alias(name)) for name, table in tables.items()])


def footprint(table: DataFrame, name: str, *columns: str) -> DataFrame:
    """Row count and estimated bytes of the named columns as text."""
    return table.agg(
        F.lit(name).alias("TableName"),
        F.count("*").alias("TableRows"),
        F.coalesce(F.sum(measures.byte_length(*columns)), F.lit(0)).alias("EstimatedBytes"),
    )
