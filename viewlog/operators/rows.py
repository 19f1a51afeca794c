"""Projections and filters over raw and staged rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.functions import calendar, measures


def nothing(spark: SparkSession, layout: T.StructType) -> DataFrame:
    """An empty frame that the optimizer knows to be empty, so that joins and unions with it cost nothing."""
    return spark.range(1).select(*[F.lit(None).cast(one.dataType).alias(one.name) for one in layout]).limit(0)


def as_date(day: date | str) -> date:
    """A date from itself or from ISO text; other text raises ``ValueError``."""
    return date.fromisoformat(day) if isinstance(day, str) else day


def flatten(raw: DataFrame) -> DataFrame:
    """The fields of ``_source`` as columns, plus ``DateValue``, ``SourceFile``, ``Line`` and ``Reason`` if there."""
    extra = [name for name in ("DateValue", "SourceFile", "Line", "Reason") if name in raw.columns]
    return raw.select("_source.*", *extra).withColumn("TotalDuration", measures.whole_seconds("TotalDuration"))


def staging_rows(raw: DataFrame, run_date: date | str | None = None, rejected: bool = False) -> DataFrame:
    """Raw records as staging rows.

    The event date is the record's own ``Date``, else the file-name date, else ``run_date``. Lines
    that did not parse are left out; ``landing.line_counts`` counts them. ``SourceFile`` stays if it is there.
    With ``rejected``, which needs ``landing.parse_lines``, these lines stay, with ``Line`` and ``Reason``.
    """
    flat = flatten(raw if rejected else raw.where(F.col("_source").isNotNull()))
    days = [calendar.parse_day(name) for name in ("Date", "DateValue") if name in flat.columns]
    days.append(F.lit(run_date).cast("date"))
    extra = [name for name in ("SourceFile",) if name in flat.columns] + (["Line", "Reason"] if rejected else [])
    day = F.when(F.col("Reason").isNull(), F.coalesce(*days)) if rejected else F.coalesce(*days)
    return flat.select("Contract", "Mac", "AppName", "TotalDuration", day.alias("EventDate"), *extra)


def on_date(rows: DataFrame, day: date | str | None, column: str = "EventDate") -> DataFrame:
    """Rows of one date, or all of them when no date is given.

    No predicate at all is added in the second case, so a given date prunes partitions.
    """
    return rows if day is None else rows.where(F.col(column) == F.lit(day).cast("date"))


def on_dates(rows: DataFrame, days: list[date] | None, column: str = "EventDate") -> DataFrame:
    """Rows of the listed dates, or all of them when the list is None."""
    if days is None:
        return rows
    return rows.where(F.col(column).isin(*[F.lit(d).cast("date") for d in days]) if days else F.lit(False))


def trailing(
    rows: DataFrame, as_of: date | str, days: int, column: str = "DateValue", include_boundary: bool = True
) -> DataFrame:
    """Rows dated no earlier than ``days`` before ``as_of``.

    With ``include_boundary`` the day exactly ``days`` back belongs to the window.
    """
    edge = F.date_sub(F.lit(as_of).cast("date"), days)
    return rows.where(F.col(column) >= edge if include_boundary else F.col(column) > edge)


def between(rows: DataFrame, start: date | str, end: date | str, column: str = "DateValue") -> DataFrame:
    return rows.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def of_contract(rows: DataFrame, contract: str | None, column: str = "ContractID") -> DataFrame:
    """Rows of one contract; None means all contracts."""
    return rows if contract is None else rows.where(F.col(column) == contract)


def complete(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in every named column."""
    condition: Column = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return rows.where(condition)


def with_category(rows: DataFrame, labels: str = "vi") -> DataFrame:
    return rows.withColumn("Type", measures.category_of("AppName", labels))


def with_hours(rows: DataFrame, **seconds: str) -> DataFrame:
    """Add hour columns, given as ``new_name="seconds_column"``."""
    return rows.withColumns({name: measures.hours(column) for name, column in seconds.items()})


def preview(rows: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return rows.orderBy(*order).limit(n)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union that fills columns a frame lacks with NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
