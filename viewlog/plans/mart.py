"""Reporting marts: flat tables computed from the star schema, and the jobs that load them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import calendar, measures
from viewlog.operators import aggregates, rows, states
from viewlog.plans import warehouse as wh
from viewlog.session import together
from viewlog.sinks.versioned import Table, VersionedStore, given

ANALYTICS = "dm_contract_analytics"
DAILY = "dm_daily_summary"
TREND = "dm_content_type_trend"
MEDIA = "media_report"

# The analytics files are sorted by contract, so a one-contract report skips most row groups.
TABLES = (
    Table(ANALYTICS, schema.DM_CONTRACT_ANALYTICS, dated_by="DateValue", sort_by=("ContractID",),
          rules=given("DateValue", "ContractID", "TotalDevices")),
    Table(DAILY, schema.DM_DAILY_SUMMARY, dated_by="DateValue", rules=given("DateValue"), unique=("DateValue",)),
    Table(TREND, schema.DM_CONTENT_TYPE_TREND, dated_by="DateValue", rules=given("DateValue", "ContentType")),
)
SOURCE = "warehouse"  # the name under which the marts note which of its runs they have taken in


def mart_store(spark: SparkSession, root: str) -> VersionedStore:
    return VersionedStore(spark, root, TABLES)


def media_store(spark: SparkSession, root: str) -> VersionedStore:
    return VersionedStore(spark, root, [Table(MEDIA, schema.MEDIA_REPORT, dated_by="ReportDate")])


def with_calendar(facts: DataFrame, days: DataFrame) -> DataFrame:
    """Fact rows with the calendar columns of their date key."""
    return facts.join(F.broadcast(days.drop("DayOfWeek", "DayName", "IsWeekend")), "DateKey")


def contract_summary_days(summary: DataFrame, days: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contract summaries with calendar columns and the contract id.

    The summary holds one row per contract and day, so no contract has more rows than the calendar
    has days and the join on the contract cannot be lopsided.
    """
    return with_calendar(summary, days).join(contracts, "ContractKey")


def first_days(rows_by_day: DataFrame, contract: str) -> DataFrame:
    """First date of every contract."""
    return rows_by_day.groupBy(contract).agg(F.min("DateValue").alias("FirstDate"))


def with_first_day(days: DataFrame, contract: str) -> DataFrame:
    """Add each contract's first date among these very rows (at most one row per calendar day)."""
    first = F.min("DateValue").over(Window.partitionBy(contract))
    return days.withColumn("FirstDate", first)


def with_activation(days: DataFrame) -> DataFrame:
    """Days since the contract's first date, both counted, and the level they fall in."""
    return days.withColumn("ActivationDays", calendar.days_inclusive("FirstDate", "DateValue")).withColumn(
        "ActivationLevel",
        measures.level_of("ActivationDays", schema.SINCE_FIRST_LIMITS, schema.SINCE_FIRST_LEVELS),
    )


def with_favourite(days: DataFrame, prefix: str) -> DataFrame:
    """Add the most watched category of the day and its seconds."""
    durations = [F.col(f"{prefix}_{c.suffix}") for c in schema.CATEGORIES]
    return days.withColumns({
        "MostWatchContentType": measures.best_label(durations, [c.label for c in schema.CATEGORIES]),
        "MostWatchDuration": measures.best_duration(durations),
    })


def contract_analytics(days: DataFrame) -> DataFrame:
    """Mart rows per date and contract, from summaries that carry calendar, id and first date."""
    shaped = with_activation(with_favourite(days, "TotalDuration"))
    names = {f"TotalDuration_{c.suffix}": f"Duration_{c.suffix}" for c in schema.ALL_CATEGORIES}
    names["TotalDuration_All"] = "Duration_Total"
    return shaped.withColumnsRenamed(names).select(*schema.DM_CONTRACT_ANALYTICS.names)


def daily_summary(days: DataFrame) -> DataFrame:
    """Mart rows per date, from summaries that carry the calendar columns.

    The summary has one row per contract and day, so counting rows counts distinct contracts and
    only one partial row per date and task is shuffled.
    """
    sums = [f"TotalDuration_{c.suffix}" for c in schema.CATEGORIES] + ["TotalDuration_All"]
    return (
        days.groupBy("DateValue", "Year", "Month", "Day")
        .agg(
            F.count("*").alias("TotalContracts"),
            F.sum("TotalDevices").alias("TotalDevices"),
            *[F.sum(name).alias(name) for name in sums],
        )
        .select(*schema.DM_DAILY_SUMMARY.names)
    )


def content_type_trend(facts: DataFrame, contract: str = "ContractKey") -> DataFrame:
    """Mart rows per date and category, from facts that carry calendar columns and ``ContentType``."""
    return (
        facts.groupBy("DateValue", "Year", "Month", "ContentType")
        .agg(
            F.sum("TotalDuration").alias("TotalDuration"),
            F.sum("SessionCount").alias("TotalSessions"),
            F.countDistinct(contract).alias("UniqueContracts"),
        )
        .select(*schema.DM_CONTENT_TYPE_TREND.names)
    )


def keyed_trend(facts: DataFrame, small: wh.SmallDims) -> DataFrame:
    """``content_type_trend`` of facts with dense contract keys: they are counted as bitmaps and not shuffled."""
    counted = states.counted(states.active_state(facts, "DateKey", "ContentTypeKey"), "DateKey", "ContentTypeKey")
    return trend_rows(counted, small).select(*schema.DM_CONTENT_TYPE_TREND.names)


def trend_rows(facts: DataFrame, small: wh.SmallDims) -> DataFrame:
    """Facts with calendar columns and category name."""
    types = small.content_type.select("ContentTypeKey", F.col("TypeName").alias("ContentType"))
    return with_calendar(facts, small.date).join(F.broadcast(types), "ContentTypeKey")


def known_logs(logs: DataFrame, calendar_range: tuple[str, str] = schema.CALENDAR) -> DataFrame:
    """Log rows that would reach the facts, with their category.

    The calendar is one unbroken range and the application list is fixed, so membership is a
    predicate that reaches the scan, and no dimension has to be joined.
    """
    calendar_days = rows.between(logs, *calendar_range, "EventDate")
    listed = rows.complete(calendar_days, "Contract", "Mac").where(F.col("AppName").isin(*schema.KNOWN_APPS))
    return listed.withColumn("AppCategory", measures.category_of("AppName"))


def days_from_logs(logs: DataFrame) -> DataFrame:
    """The frame of ``contract_summary_days`` straight from log rows, without stored star tables.

    Contract and device ids stand in for their surrogate keys, which changes no result. The date
    stays a grouping column, so a report's date filter reaches the scan of the logs.
    """
    summed = aggregates.contract_days(
        known_logs(logs), "EventDate", "Contract",
        kind="AppCategory", device="Mac", prefix="TotalDuration", total="All")
    return calendar.with_calendar_columns(
        summed.withColumnsRenamed({"EventDate": "DateValue", "Contract": "ContractID"}))


def trend_from_logs(logs: DataFrame) -> DataFrame:
    """The frame of ``trend_rows`` straight from log rows."""
    renamed = known_logs(logs).withColumnsRenamed({"EventDate": "DateValue", "AppCategory": "ContentType"})
    return calendar.with_calendar_columns(renamed).withColumns(
        {"TotalDuration": measures.or_zero("TotalDuration"), "SessionCount": F.lit(1)})


def favourite_by_ranking(summary: DataFrame, prefix: str = "TotalDuration") -> DataFrame:
    """Most watched category as a ranking of the row's own columns; NULL when none is positive.

    Gives what ``with_favourite`` gives, by listing the (seconds, category) pairs of the row, keeping
    the positive ones and taking the largest, the earlier category on a tie. No join and no shuffle.
    """
    pairs = F.array(*[
        F.struct(measures.or_zero(f"{prefix}_{c.suffix}").alias("Duration"), F.lit(-n).alias("Priority"),
                 F.lit(c.label).alias("ContentType"))
        for n, c in enumerate(schema.CATEGORIES)
    ])
    best = F.array_max(F.filter(pairs, lambda pair: pair["Duration"] > 0))
    return summary.withColumn("_best", best).select(
        "*", F.col("_best.ContentType").alias("ContentType"), measures.or_zero("_best.Duration").alias("Duration"),
    ).drop("_best")


def load_mart(
    spark: SparkSession,
    warehouse: VersionedStore,
    mart: VersionedStore,
    process_date: date | str | None = None,
    first_date_scope: str = "history",
    process_dates: list[date] | None = None,
    calendar_range: tuple[str, str] = schema.CALENDAR,
) -> dict[str, int]:
    """Load the three marts from the star schema, for all dates or the given ones.

    Activation counts from the contract's first date in the whole history; with
    ``first_date_scope="filtered"`` it counts from its first date among the loaded ones.
    All is read from the warehouse as it is at the start; the marts note that they have taken it in if
    the given dates hold all that it changed since they last did. Returns the rows written per table.
    """
    if first_date_scope not in ("history", "filtered"):
        raise ValueError(f"first_date_scope must be 'history' or 'filtered', not {first_date_scope!r}")
    if process_date is not None:
        process_dates = [rows.as_date(process_date)]
    warehouse = warehouse.snapshot()
    taken = {SOURCE: warehouse.last_run()} if _covers(process_dates, warehouse, mart) else None
    small = wh.SmallDims.build(spark, calendar=calendar_range)
    summary = on_keys(warehouse.read(wh.SUMMARY), process_dates)
    facts = on_keys(warehouse.read(wh.FACTS), process_dates)

    days = contract_summary_days(summary, small.date, warehouse.read(wh.CONTRACTS))
    if first_date_scope == "filtered":
        days = with_first_day(days, "ContractKey")
    else:  # first dates are stored, a row per contract; no other date is read
        first = F.to_date(F.col("FirstDateKey").cast("string"), "yyyyMMdd").alias("FirstDate")
        days = days.join(wh.first_dates(warehouse).select("ContractKey", first), "ContractKey")

    run = mart.begin()
    together(
        spark,
        lambda: run.write(ANALYTICS, contract_analytics(days)),
        lambda: run.write(DAILY, daily_summary(with_calendar(summary, small.date))),
        lambda: run.write(TREND, keyed_trend(facts, small)))
    run.publish(replaces=process_dates, taken=taken)
    return run.counts


def _covers(dates: list[date] | None, warehouse: VersionedStore, mart: VersionedStore) -> bool:
    """Whether loading these dates takes in all that the warehouse has changed."""
    if dates is None:
        return True
    changed = loaded_dates(warehouse, mart)
    return changed is not None and {*changed} <= {*dates} and {*moved_dates(warehouse, mart.taken(SOURCE))} <= {*dates}


def loaded_dates(warehouse: VersionedStore, mart: VersionedStore) -> list[date] | None:
    """The dates of all warehouse loads that the marts have not taken in; None meaning every date."""
    loads = warehouse.loads_after(mart.taken(SOURCE))
    if any(load.dates is None for load in loads):
        return None
    return sorted({day for load in loads for day in load.dates})


def pending_dates(warehouse: VersionedStore, mart: VersionedStore) -> list[date] | None:
    """The dates the marts have to rebuild to be those of the warehouse; None meaning every date.

    These are the dates of the loads they have not taken in, and where such a load moved a contract's
    first date, its other dates. How many loads there were, and whether they were folded since, does
    not matter.
    """
    dates = loaded_dates(warehouse, mart)
    return None if dates is None else sorted({*dates, *moved_dates(warehouse, mart.taken(SOURCE))})


def catch_up(
    spark: SparkSession, warehouse: VersionedStore, mart: VersionedStore, calendar_range: tuple[str, str] = schema.CALENDAR,
) -> dict[str, int]:
    """Take in whatever the warehouse has changed since the marts last did; nothing if it has not."""
    warehouse = warehouse.snapshot()
    dates = pending_dates(warehouse, mart)
    if dates == []:
        return {table.name: 0 for table in TABLES}
    return load_mart(spark, warehouse, mart, process_dates=dates, calendar_range=calendar_range)


def moved_dates(warehouse: VersionedStore, after: int | None = None) -> list[date]:
    """All dates of the contracts whose first date was moved by the newest load, or by runs after ``after``.

    Their activation changes on every date. New contracts have no other dates, so they are not looked
    up; at most one entry per calendar day comes back.
    """
    after = warehouse.last_run() - 1 if after is None else after
    changes = warehouse.read(wh.FIRST, with_run=True).where(wh.change_run() > after)
    moved = changes.where(F.col("WasDateKey").isNotNull()).select("ContractKey")
    dates = warehouse.read(wh.SUMMARY).join(moved, "ContractKey", "left_semi").select("DateKey").distinct()
    return [date.fromisoformat(str(row.DateKey)) for row in dates.collect()]


def on_keys(facts: DataFrame, process_dates: list[date] | None) -> DataFrame:
    """Fact rows of the given dates, as a plain predicate on the partition column."""
    if process_dates is None:
        return facts
    return facts.where(F.col("DateKey").isin([int(f"{day:%Y%m%d}") for day in process_dates]))


_on_keys = on_keys  # its earlier name


def load_media_report(
    spark: SparkSession, staging: DataFrame, store: VersionedStore, process_date: date | str | None = None,
    process_dates: list[date] | None = None,
) -> dict[str, int]:
    """Load the older mart, seconds and rows per date and application, straight from staging.

    Rows without a date are stored when all dates are loaded. Loading one date replaces that date only.
    """
    dates = process_dates if process_date is None else [rows.as_date(process_date)]
    run = store.begin()
    run.write(MEDIA, aggregates.media_report(rows.on_dates(staging, dates)))
    run.publish(replaces=dates)
    return run.counts


def clear_marts(mart: VersionedStore) -> dict[str, dict[str, int]]:
    """Empty the three marts; returns their row counts before and after."""
    before = _counts(mart)
    run = mart.begin()
    for table in TABLES:
        run.write(table.name, mart.spark.createDataFrame([], table.layout))
    run.publish()
    return {"before": before, "after": _counts(mart)}


def _counts(mart: VersionedStore) -> dict[str, int]:
    return aggregates.table_counts(**{t.name: mart.read(t.name) for t in TABLES}).first().asDict()
