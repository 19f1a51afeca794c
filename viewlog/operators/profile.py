"""Per-contract measures of the direct route: devices, durations, favourite, activation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import calendar, measures


def device_rows(rows: DataFrame) -> DataFrame:
    """Rows per contract. The direct route calls this its device count."""
    return rows.groupBy("Contract").agg(F.count("*").alias("TotalDevices"))


def devices_distinct(rows: DataFrame, *by: str, device: str = "Mac") -> DataFrame:
    """Distinct devices per group."""
    return rows.groupBy(*by).agg(F.countDistinct(device).alias("TotalDevices"))


def duration_by_category(rows: DataFrame) -> DataFrame:
    return rows.groupBy("Contract", "Type").agg(F.sum("TotalDuration").alias("TotalDuration"))


def duration_pivot(rows: DataFrame, labels: str = "vi") -> DataFrame:
    """One row per contract with one column per category, 0 where it watched none.

    The category list is fixed, so Spark needs no extra job to find it and a category that no row
    has still gets its column.
    """
    names = schema.category_labels(labels)
    summed = duration_by_category(rows)
    return summed.groupBy("Contract").pivot("Type", names).agg(F.sum("TotalDuration")).na.fill(0)


def with_most_watched(stats: DataFrame, labels: str = "vi") -> DataFrame:
    """Add the category with the largest positive duration; the earlier category wins a tie."""
    names = schema.category_labels(labels, with_unknown=False)
    durations = [F.col(f"`{name}`") for name in names]
    return stats.withColumns({
        "MostWatchContentType": measures.best_label(durations, names),
        "MostWatchDuration": measures.best_duration(durations),
    })


def activation_span(rows: DataFrame, day: str = "EventDate") -> DataFrame:
    """Days from the first to the last date of each contract, and the level they fall in."""
    bounds = rows.groupBy("Contract").agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return _with_span(bounds).select("Contract", "ActivationDays", "ActivationLevel")


def one_per_contract(rows: DataFrame, day: str = "EventDate") -> DataFrame:
    """One row per contract: first and last date and number of rows."""
    return rows.groupBy("Contract").agg(
        F.min(day).alias("FirstDate"), F.max(day).alias("LastDate"), F.count("*").alias("RowsCount"))


def _with_span(bounds: DataFrame) -> DataFrame:
    days = calendar.days_inclusive("_first", "_last")
    return bounds.withColumn("ActivationDays", days).withColumn(
        "ActivationLevel", measures.level_of("ActivationDays", schema.SPAN_LIMITS, schema.SPAN_LEVELS)
    )


def join_devices(stats: DataFrame, devices: DataFrame) -> DataFrame:
    """Statistics with the device count of the same contract; a NULL contract drops out."""
    return stats.join(devices, "Contract", "inner")


def join_activation(profile: DataFrame, activation: DataFrame | None) -> DataFrame:
    """Profile with activation when there is one."""
    return profile if activation is None else profile.join(activation, "Contract", "left")


def contract_profile(rows: DataFrame, labels: str = "vi", day: str | None = "EventDate") -> DataFrame:
    """Durations per category, favourite category, device rows and activation of every contract.

    One aggregation on the contract yields all of it, so the raw rows are shuffled once, after
    map-side pre-aggregation, and there is no join. ``day=None`` leaves activation out.
    """
    app, seconds = F.col("AppName"), F.col("TotalDuration")
    members = {c: app.isin(*c.apps) for c in schema.CATEGORIES}
    members[schema.UNKNOWN] = app.isNull() | ~app.isin(*schema.KNOWN_APPS)
    sums = [measures.or_zero(F.sum(F.when(member, seconds))).alias(schema.label_of(c, labels))
            for c, member in members.items()]
    bounds = [F.min(day).alias("_first"), F.max(day).alias("_last")] if day else []
    grouped = (
        rows.where(F.col("Contract").isNotNull())
        .groupBy("Contract")
        .agg(*sums, F.count("*").alias("TotalDevices"), *bounds)
    )
    profile = with_most_watched(grouped, labels)
    return _with_span(profile).drop("_first", "_last") if day else profile
