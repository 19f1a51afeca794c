"""Data-quality checks on staging, dimensions, facts and marts.

Checks that compare staging with the dimensions work on distinct values or on the session grain,
never on raw rows, so a value that fills a third of staging costs no more than any other.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.functions import measures
from viewlog.operators import aggregates, joins, rows
from viewlog.plans.warehouse import SmallDims

Day = date | str


def staging_profile(staging: DataFrame) -> DataFrame:
    """Rows, first and last date, number of dates."""
    return staging.agg(
        F.count("*").alias("TotalRows"),
        F.min("EventDate").alias("MinDate"),
        F.max("EventDate").alias("MaxDate"),
        F.countDistinct("EventDate").alias("DistinctDates"),
    )


def day_profile(staging: DataFrame, day: Day) -> DataFrame:
    """Rows, contracts and devices of one date."""
    return rows.on_date(staging, day).agg(
        F.count("*").alias("DayRows"),
        F.countDistinct("Contract").alias("DistinctContracts"),
        F.countDistinct("Mac").alias("DistinctMacs"),
    )


def value_match(values: DataFrame, column: str, dimension: DataFrame, dimension_column: str) -> DataFrame:
    """How many distinct values staging has, how many of them the dimension has."""
    known = F.broadcast(dimension.select(F.col(dimension_column).alias("_known")))
    distinct = values.select(column).distinct()
    return distinct.join(known, F.col(column) == F.col("_known"), "left").agg(
        F.count(column).alias("DistinctInStaging"),
        F.countDistinct("_known").alias("DistinctInDimension"),
        F.countDistinct(F.when(F.col("_known").isNotNull(), F.col(column))).alias("Matched"),
    )


def app_match(staging: DataFrame, small: SmallDims) -> DataFrame:
    return value_match(staging, "AppName", small.app, "AppName")


def with_dim_category(staging: DataFrame, small: SmallDims) -> DataFrame:
    """Staging with the category its application has in the dimension, NULL for unlisted ones."""
    return staging.join(F.broadcast(small.app.select("AppName", "AppCategory")), "AppName", "left")


def category_match(staging: DataFrame, small: SmallDims) -> DataFrame:
    return value_match(with_dim_category(staging, small), "AppCategory", small.content_type, "TypeName")


def date_match(staging: DataFrame, small: SmallDims) -> DataFrame:
    return value_match(staging, "EventDate", small.date, "DateValue")


def _pair_counts(matched: DataFrame) -> DataFrame:
    """Sessions per (contract, device) pair: all of them, and those matching the small dimensions."""
    return matched.groupBy("Contract", "Mac").agg(
        F.sum("SessionCount").alias("Sessions"),
        F.sum(F.when(F.col("SmallMatch"), F.col("SessionCount")).otherwise(0)).alias("SmallMatches"),
    )


def _with_small_dims(grain: DataFrame, small: SmallDims) -> DataFrame:
    """Session grain with the keys of the small dimensions, NULL where there is no match."""
    days = small.date.select("DateKey", F.col("DateValue").alias("EventDate"))
    types = small.content_type.select("ContentTypeKey", F.col("TypeName").alias("AppCategory"))
    found = (
        grain.join(F.broadcast(days), "EventDate", "left")
        .join(F.broadcast(small.app), "AppName", "left")
        .join(F.broadcast(types), "AppCategory", "left")
    )
    every = F.col("DateKey").isNotNull() & F.col("AppKey").isNotNull() & F.col("ContentTypeKey").isNotNull()
    return found.withColumn("SmallMatch", every)


def _pair_matches(
    grain: DataFrame, matched: DataFrame, contracts: DataFrame, devices: DataFrame
) -> DataFrame:
    """Session counts per pair with contract and device key, NULL where there is no match.

    Pairs are what is joined. A key has no more pairs than sessions, so one that is light there is light here.
    """
    pairs = joins.lookup(
        _pair_counts(matched), contracts.select("ContractKey", "ContractID"), "Contract", "ContractID",
        joins.heavy_keys(grain, "Contract"), spread=["Mac"], how="left")
    return joins.lookup(
        pairs, devices.select("DeviceKey", "MacAddress"), "Mac", "MacAddress",
        joins.heavy_keys(grain, "Mac"), spread=["Contract"], how="left")


def joinable_rows(grain: DataFrame, small: SmallDims, contracts: DataFrame, devices: DataFrame) -> DataFrame:
    """Staging rows that find all five dimensions."""
    pairs = _pair_matches(grain, _with_small_dims(grain, small), contracts, devices)
    found = rows.complete(pairs, "ContractKey", "DeviceKey")
    return found.agg(measures.or_zero(F.sum("SmallMatches")).alias("RowsThatCanJoin"))


def unjoinable(grain: DataFrame, small: SmallDims, contracts: DataFrame, devices: DataFrame) -> DataFrame:
    """Staging rows that miss some dimension, and the distinct values missing from each.

    The large dimensions are matched per (contract, device) pair, so no session row is shuffled for
    them; the three small ones are matched where the sessions lie.
    """
    def missing(key: str, value: str, name: str):
        return F.countDistinct(F.when(F.col(key).isNull(), F.col(value))).alias(name)

    matched = _with_small_dims(grain, small)
    pairs = _pair_matches(grain, matched, contracts, devices)
    both = F.col("ContractKey").isNotNull() & F.col("DeviceKey").isNotNull()
    failing = F.col("Sessions") - F.when(both, F.col("SmallMatches")).otherwise(0)
    return aggregates.side_by_side(
        pairs.agg(
            measures.or_zero(F.sum(failing)).alias("RowsCannotJoin"),
            missing("ContractKey", "Contract", "MissingContracts"),
            missing("DeviceKey", "Mac", "MissingDevices"),
        ),
        matched.where(~F.col("SmallMatch")).agg(
            missing("DateKey", "EventDate", "MissingDates"),
            missing("AppKey", "AppName", "MissingApps"),
            missing("ContentTypeKey", "AppCategory", "MissingContentTypes"),
        ),
    )


def top_apps(staging: DataFrame, small: SmallDims, n: int = 10) -> DataFrame:
    """The applications with most rows; counted first, so the category is joined to few rows."""
    counts = staging.groupBy("AppName").agg(F.count("*").alias("RowsCount"))
    return with_dim_category(counts, small).select("AppName", "AppCategory", "RowsCount").orderBy(
        F.desc("RowsCount"), F.asc_nulls_first("AppName")).limit(n)


def fact_range(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("TotalSessions"),
        F.min("DateKey").alias("MinDateKey"),
        F.max("DateKey").alias("MaxDateKey"),
    )


def summary_for_day(summary: DataFrame, days: DataFrame, day: Day) -> DataFrame:
    """Summary rows of one date, with the date."""
    chosen = rows.on_date(days.select("DateKey", "DateValue"), day, "DateValue")
    return summary.join(F.broadcast(chosen), "DateKey")


def complete_rows(staging: DataFrame, day: Day | None) -> DataFrame:
    """Rows of a date that have contract, device and application."""
    return rows.complete(rows.on_date(staging, day), "Contract", "Mac", "AppName").agg(
        F.count("*").alias("CompleteRows"))


def new_keys(staging: DataFrame, contracts: DataFrame, devices: DataFrame, day: Day | None) -> DataFrame:
    """Contracts and devices of a date that the dimensions lack."""
    today = rows.on_date(staging, day)
    counts = {}
    for name, column, known, known_column in (
        ("NewContracts", "Contract", contracts, "ContractID"),
        ("NewDevices", "Mac", devices, "MacAddress"),
    ):
        values = rows.complete(today, column).select(column).distinct()
        counts[name] = joins.not_in(values, known, column, known_column)
    return aggregates.table_counts(**counts)


def duplicates(table: DataFrame, key: str, name: str) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = table.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return repeated.agg(F.lit(name).alias("CheckName"), F.count("*").alias("Violations"))


def _flagged(table: DataFrame, key: str, dimension: DataFrame) -> DataFrame:
    """The table with ``lost_<key>``: whether the dimension lacks the row's key."""
    known = dimension.select(key, F.lit(True).alias("_known"))
    return table.join(known, key, "left").withColumn(f"lost_{key}", F.col("_known").isNull()).drop("_known")


def orphans(table: DataFrame, name: str, small: dict[str, DataFrame], large: dict[str, DataFrame]) -> DataFrame:
    """Number of rows per key column whose key a dimension lacks, from one pass over the table.

    The fixed dimensions are matched where the rows lie. Rows are then counted by their large keys,
    and only those counts meet the large dimensions.
    """
    for key, dimension in small.items():
        table = _flagged(table, key, F.broadcast(dimension))
    counts = table.groupBy(*large).agg(
        F.count("*").alias("_n"), *[F.count_if(f"lost_{key}").alias(f"{name}.{key}") for key in small])
    for key, dimension in large.items():
        counts = _flagged(counts, key, dimension)
    names = [f"{name}.{key}" for key in (*small, *large)]
    wide = counts.agg(
        *[F.sum(f"`{name}.{key}`").alias(f"{name}.{key}") for key in small],
        *[F.sum(F.when(F.col(f"lost_{key}"), F.col("_n")).otherwise(0)).alias(f"{name}.{key}") for key in large])
    found = wide.unpivot([], [F.col(f"`{column}`") for column in names], "CheckName", "Violations")
    return found.withColumn("Violations", F.coalesce("Violations", F.lit(0)))


def missing_values(table: DataFrame, name: str, *columns: str) -> DataFrame:
    """Number of NULLs per column as (check, violations) rows, from one pass over the table."""
    wide = table.agg(*[F.count_if(F.col(c).isNull()).alias(f"{name}.{c}") for c in columns])
    return wide.unpivot([], [F.col(f"`{name}.{c}`") for c in columns], "CheckName", "Violations")


def unique_checks(small: SmallDims, contracts: DataFrame, devices: DataFrame, daily: DataFrame) -> DataFrame:
    checks = (
        duplicates(contracts, "ContractID", "dim_contract.ContractID"),
        duplicates(devices, "MacAddress", "dim_device.MacAddress"),
        duplicates(small.app, "AppName", "dim_app.AppName"),
        duplicates(small.content_type, "TypeName", "dim_content_type.TypeName"),
        duplicates(daily, "DateValue", "dm_daily_summary.DateValue"),
    )
    return rows.union_by_name(*checks)


def foreign_key_checks(
    facts: DataFrame, summary: DataFrame, small: SmallDims, contracts: DataFrame, devices: DataFrame
) -> DataFrame:
    return rows.union_by_name(
        orphans(devices, "dim_device", {}, {"ContractKey": contracts}),
        orphans(
            facts, "fact_viewing_session",
            {"DateKey": small.date, "AppKey": small.app, "ContentTypeKey": small.content_type},
            {"ContractKey": contracts, "DeviceKey": devices}),
        orphans(summary, "fact_contract_summary", {"DateKey": small.date}, {"ContractKey": contracts}),
    )


def not_null_checks(facts: DataFrame, analytics: DataFrame) -> DataFrame:
    fact_columns = ("DateKey", "ContractKey", "DeviceKey", "AppKey", "ContentTypeKey", "TotalDuration")
    mart_columns = ("DateValue", "Year", "Quarter", "Month", "MonthName", "Day", "ContractID", "TotalDevices")
    return missing_values(facts, "fact_viewing_session", *fact_columns).unionByName(
        missing_values(analytics, "dm_contract_analytics", *mart_columns))
