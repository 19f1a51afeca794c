"""One entry per operator or report: name -> function of the shared frames."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import calendar, measures
from viewlog.operators import aggregates, joins, keys, profile, rows
from viewlog.plans import dims, mart, pipeline, quality, report, rollups
from viewlog.plans import warehouse as wh
from viewlog.plans.journal import Journal
from viewlog.registry.frames import (
    AS_OF,
    LOADED_BEFORE,
    ONE_CONTRACT,
    ONE_DAY,
    ORDERS_AS_OF,
    ORDERS_DAYS,
    RANGE,
    SHORT,
    Frames,
)
from viewlog.session import scratch_path
from viewlog.sinks import files
from viewlog.sinks.versioned import Refused, Rule, RulesBroken
from viewlog.sources import adapter, landing
from viewlog.streaming import jobs

Query = Callable[[Frames], DataFrame]
_REGISTERED: dict[str, Query] = {}


def calendar_day(day: str, days: int) -> date:
    return date.fromisoformat(day) + timedelta(days=days)


def query(build: Query) -> Query:
    _REGISTERED[build.__name__] = build
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Frames(spark, sf_dir))

    return {name: bind(build) for name, build in _REGISTERED.items()}


# --- Sources -------------------------------------------------------------------------------


@query
def raw_scan(f: Frames) -> DataFrame:
    return rows.flatten(landing.read_file(f.spark, f.landing))


@query
def raw_scan_many(f: Frames) -> DataFrame:
    flat = rows.flatten(landing.read_files(f.spark, f.landing_paths))
    return flat.groupBy("Date").agg(F.count("*").alias("Lines"), F.sum("TotalDuration").alias("TotalDuration"))


@query
def date_from_filename(f: Frames) -> DataFrame:
    raw = landing.with_name_date(landing.read_file(f.spark, f.landing), level="folder")
    return raw.groupBy("DateValue").agg(F.count("*").alias("Lines"))


@query
def sample_preview(f: Frames) -> DataFrame:
    return rows.preview(f.staging, 10, "EventDate", "Contract", "Mac", "AppName", "TotalDuration")


@query
def staging_scan(f: Frames) -> DataFrame:
    return rows.on_date(f.stage(), None)


# --- Projections and filters ---------------------------------------------------------------


@query
def flatten_log(f: Frames) -> DataFrame:
    return rows.flatten(landing.with_name_date(landing.read_file(f.spark, f.landing), level="folder"))


@query
def staging_rows(f: Frames) -> DataFrame:
    return rows.staging_rows(landing.read_file(f.spark, f.landing), run_date=AS_OF)


@query
def process_date_filter(f: Frames) -> DataFrame:
    return rows.on_date(f.staging, ONE_DAY)


@query
def app_category(f: Frames) -> DataFrame:
    both = rows.with_category(f.staging).withColumn("EnglishType", measures.category_of("AppName", "en"))
    return both.select("Contract", "AppName", "Type", "EnglishType", "TotalDuration")


@query
def not_null_keys(f: Frames) -> DataFrame:
    return rows.complete(f.staging, "Contract", "Mac", "AppName")


@query
def trailing_days(f: Frames) -> DataFrame:
    # Days are counted once; the windows then overlap on a row per day.
    per_day = f.written("per-day", rows.trailing(f.staging, AS_OF, 30, "EventDate").groupBy("EventDate").agg(
        F.count("*").alias("RowsCount"), F.sum("TotalDuration").alias("TotalDuration")))
    windows = [
        rows.trailing(per_day, AS_OF, n, "EventDate", boundary).select(
            F.lit(n).alias("Days"), F.lit(int(boundary)).alias("WithBoundary"), "EventDate", "RowsCount", "TotalDuration")
        for n in (1, 7, 30)
        for boundary in (True, False)
    ]
    return rows.union_by_name(*windows)


@query
def date_between(f: Frames) -> DataFrame:
    return rows.between(f.staging, *RANGE, column="EventDate")


@query
def contract_filter(f: Frames) -> DataFrame:
    return rows.of_contract(f.analytics, ONE_CONTRACT)


@query
def hours_projection(f: Frames) -> DataFrame:
    names = {f"{c.suffix}_Hours": f"TotalDuration_{c.suffix}" for c in schema.CATEGORIES}
    return rows.with_hours(f.daily, **names).select("DateValue", *names)


# --- Joins ---------------------------------------------------------------------------------


@query
def profile_join_devices(f: Frames) -> DataFrame:
    stats = profile.duration_pivot(rows.with_category(f.staging))
    return profile.join_devices(stats, profile.device_rows(f.staging))


@query
def profile_join_activation(f: Frames) -> DataFrame:
    stats = profile.duration_pivot(rows.with_category(f.staging, "en"), "en")
    return profile.join_activation(profile.with_most_watched(stats, "en"), profile.activation_span(f.staging))


@query
def star_join(f: Frames) -> DataFrame:
    return wh.star_join(f.grain, f.small, f.pairs)


@query
def contract_summary_join(f: Frames) -> DataFrame:
    per_type = f.facts.groupBy("DateKey", "ContractKey", "ContentTypeKey").agg(
        F.countDistinct("DeviceKey").alias("Devices"), F.sum("TotalDuration").alias("TotalDuration"))
    named = mart.with_calendar(per_type, f.small.date).join(F.broadcast(f.small.content_type), "ContentTypeKey")
    return named.join(f.contracts, "ContractKey").select(
        "DateValue", "ContractID", "TypeName", "Devices", "TotalDuration")


@query
def mart_join(f: Frames) -> DataFrame:
    return mart.contract_summary_days(f.summary, f.small.date, f.contracts).drop("ContractKey", "DateKey")


@query
def new_contracts_anti(f: Frames) -> DataFrame:
    ids = rows.complete(f.late, "Contract").select(F.col("Contract").alias("ContractID")).distinct()
    return joins.not_in(ids, f.early_contracts, "ContractID", "ContractID")


@query
def semi_delete(f: Frames) -> DataFrame:
    doomed = rows.on_date(f.small.date, ONE_DAY, "DateValue").select("DateKey")
    return joins.not_in(f.summary, F.broadcast(doomed), "DateKey", "DateKey")


@query
def dim_match_left(f: Frames) -> DataFrame:
    counts = f.staging.groupBy("AppName").agg(F.count("*").alias("RowsCount"))
    return quality.with_dim_category(counts, f.small).select(
        "AppName", "AppCategory", "RowsCount", F.col("AppCategory").isNotNull().cast("int").alias("Matched"))


@query
def lateral_unpivot_top1(f: Frames) -> DataFrame:
    return mart.favourite_by_ranking(f.summary).select("DateKey", "ContractKey", "ContentType", "Duration")


# --- Aggregations --------------------------------------------------------------------------


@query
def device_rows(f: Frames) -> DataFrame:
    return profile.device_rows(f.staging)


@query
def devices_distinct(f: Frames) -> DataFrame:
    return profile.devices_distinct(mart.known_logs(f.staging), "EventDate", "Contract")


@query
def duration_by_category(f: Frames) -> DataFrame:
    return profile.duration_by_category(rows.with_category(f.staging))


@query
def duration_pivot(f: Frames) -> DataFrame:
    return profile.duration_pivot(rows.with_category(f.staging))


@query
def conditional_sum_wide(f: Frames) -> DataFrame:
    return aggregates.contract_days(
        mart.known_logs(f.staging), "EventDate", "Contract", kind="AppCategory", device="Mac", prefix="TotalDuration", total="All")


@query
def fact_viewing_session(f: Frames) -> DataFrame:
    return f.facts


@query
def device_first_contract(f: Frames) -> DataFrame:
    return dims.first_contract_of_device(f.owned)


@query
def distinct_contracts(f: Frames) -> DataFrame:
    return f.staging.select(F.col("Contract").alias("ContractID")).distinct().orderBy("ContractID")


@query
def daily_summary_agg(f: Frames) -> DataFrame:
    return f.keyed_daily


@query
def content_trend_agg(f: Frames) -> DataFrame:
    return f.keyed_trend


@query
def media_report(f: Frames) -> DataFrame:
    return aggregates.media_report(f.staging)


@query
def global_agg(f: Frames) -> DataFrame:
    return f.staging.agg(
        measures.or_zero(F.sum("TotalDuration")).alias("TotalDuration"),
        F.min("EventDate").alias("MinDate"), F.max("EventDate").alias("MaxDate"),
        F.count("*").alias("RowsCount"), F.count("TotalDuration").alias("DurationsCount"),
        F.countDistinct("Contract").alias("Contracts"), F.countDistinct("Mac").alias("Macs"))


@query
def integer_avg(f: Frames) -> DataFrame:
    return f.staging.groupBy("AppName").agg(measures.whole_average("TotalDuration").alias("AvgDuration"))


@query
def partial_merge(f: Frames) -> DataFrame:
    by = ["Contract", "Type"]
    typed = rows.with_category(f.staging)
    per_day = typed.groupBy("EventDate", *by).agg(F.sum("TotalDuration").alias("TotalDuration"))
    return aggregates.merge_partials(per_day, by=by, measure="TotalDuration")


@query
def distinct_on_contract(f: Frames) -> DataFrame:
    return profile.one_per_contract(f.staging)


@query
def conditional_distinct(f: Frames) -> DataFrame:
    unlisted = ~F.coalesce(F.col("AppName").isin(*schema.KNOWN_APPS), F.lit(False))
    return f.staging.agg(
        F.countDistinct(F.when(unlisted, F.col("AppName"))).alias("UnlistedApps"),
        F.countDistinct(F.when(unlisted, F.col("Contract"))).alias("ContractsWithUnlistedApps"),
        F.countDistinct(F.when(F.col("Mac").isNull(), F.col("Contract"))).alias("ContractsWithoutMac"))


@query
def scalar_subquery_counts(f: Frames) -> DataFrame:
    return aggregates.table_counts(
        TotalContracts=f.contracts, TotalDevices=f.devices,
        TotalSessions=f.stored_facts, TotalSummaries=f.stored_summary)


# --- Whole-partition windows and row-wise picks --------------------------------------------


@query
def activation_span(f: Frames) -> DataFrame:
    return profile.activation_span(f.staging)


@query
def activation_since_first(f: Frames) -> DataFrame:
    days = mart.with_first_day(mart.days_from_logs(f.staging), "ContractID")
    return mart.with_activation(days).select(
        "DateValue", "ContractID", "FirstDate", "ActivationDays", "ActivationLevel")


@query
def most_watch(f: Frames) -> DataFrame:
    stats = profile.duration_pivot(rows.with_category(f.staging, "en"), "en")
    return profile.with_most_watched(stats, "en").select("Contract", "MostWatchContentType", "MostWatchDuration")


@query
def most_watch_mart(f: Frames) -> DataFrame:
    days = mart.with_favourite(mart.days_from_logs(f.staging), "TotalDuration")
    return days.select("DateValue", "ContractID", "MostWatchContentType", "MostWatchDuration")


@query
def activation_level(f: Frames) -> DataFrame:
    seen = profile.one_per_contract(mart.known_logs(f.staging))
    return seen.select("Contract", calendar.days_inclusive("FirstDate", "LastDate").alias("Days")).select(
        "Contract", "Days",
        measures.level_of("Days", schema.SPAN_LIMITS, schema.SPAN_LEVELS).alias("SpanLevel"),
        measures.level_of("Days", schema.SINCE_FIRST_LIMITS, schema.SINCE_FIRST_LEVELS).alias("SinceFirstLevel"))


# --- Ordering, top-k, unions ---------------------------------------------------------------


@query
def top_n_contracts(f: Frames) -> DataFrame:
    return report.top_contracts(f.analytics, AS_OF, n=50, include_boundary=True)


@query
def head_of_top(f: Frames) -> DataFrame:
    return report.head_of(report.contract_leaderboard(f.analytics, AS_OF, n=50))


@query
def top_app_counts(f: Frames) -> DataFrame:
    return quality.top_apps(f.order_log, f.small)


@query
def order_by_date(f: Frames) -> DataFrame:
    return f.trend.orderBy("DateValue", "ContentType")


@query
def union_by_name(f: Frames) -> DataFrame:
    loaded = F.col("EventDate") < F.lit(LOADED_BEFORE).cast("date")
    return rows.union_by_name(f.staging.where(loaded).drop("AppName"), f.staging.where(~loaded))


@query
def union_all_distribution(f: Frames) -> DataFrame:
    return report.distribution(f.daily)


@query
def table_footprint(f: Frames) -> DataFrame:
    return rows.union_by_name(
        aggregates.footprint(f.analytics, "dm_contract_analytics", "DateValue", "ContractID"),
        aggregates.footprint(f.daily, "dm_daily_summary", "DateValue"),
        aggregates.footprint(f.trend, "dm_content_type_trend", "DateValue", "ContentType"))


# --- Scalar functions ----------------------------------------------------------------------


def _by_day(f: Frames, **expressions) -> DataFrame:
    """Expressions of the event date, computed on every row, one output row per date."""
    computed = f.staging.select("EventDate", *[e.alias(name) for name, e in expressions.items()])
    return computed.groupBy("EventDate", *expressions).agg(F.count("*").alias("RowsCount"))


@query
def fn_parse_date(f: Frames) -> DataFrame:
    day = F.col("ts").cast("date")
    shape = F.col("event_id") % 4
    text = F.when(shape == 0, F.date_format(day, "yyyyMMdd")).when(shape == 1, day.cast("string")).when(shape == 2, "zz")
    return f.events.select("event_id", text.alias("DateText"), calendar.parse_day(text).alias("Parsed"))


@query
def fn_date_key(f: Frames) -> DataFrame:
    return _by_day(f, DateKey=calendar.date_key("EventDate"))


@query
def fn_calendar_parts(f: Frames) -> DataFrame:
    return _by_day(f, Year=F.year("EventDate"), Quarter=F.quarter("EventDate"),
                   Month=F.month("EventDate"), Day=F.dayofmonth("EventDate"))


@query
def fn_names(f: Frames) -> DataFrame:
    return _by_day(f, MonthName=calendar.month_name("EventDate"), DayName=calendar.day_name("EventDate"))


@query
def fn_weekday(f: Frames) -> DataFrame:
    return _by_day(f, DayOfWeek=F.dayofweek("EventDate"), IsWeekend=calendar.is_weekend("EventDate"))


@query
def fn_date_math(f: Frames) -> DataFrame:
    as_of = F.lit(AS_OF).cast("date")
    return _by_day(f, NextDay=F.date_add("EventDate", 1), WeekBefore=F.date_sub("EventDate", 7),
                   DaysToEnd=F.datediff(as_of, F.col("EventDate")),
                   DaysInclusive=calendar.days_inclusive("EventDate", as_of))


@query
def fn_null_default(f: Frames) -> DataFrame:
    return f.staging.select(
        "Contract", "EventDate", measures.or_zero("TotalDuration").alias("Duration"),
        F.coalesce("Mac", F.lit("none")).alias("MacOrNone"),
        F.col("AppName").isNull().cast("int").alias("NoApp"))


@query
def fn_case(f: Frames) -> DataFrame:
    band = F.when(F.col("TotalDuration") < 600, "short").when(F.col("TotalDuration") < 3600, "middle").otherwise("long")
    return f.staging.groupBy(band.alias("Band")).agg(F.count("*").alias("RowsCount"))


@query
def fn_greatest(f: Frames) -> DataFrame:
    stats = profile.duration_pivot(rows.with_category(f.staging, "en"), "en")
    names = schema.category_labels("en", with_unknown=False)
    return stats.select("Contract", F.greatest(*names).alias("Greatest"))


@query
def fn_casts(f: Frames) -> DataFrame:
    return f.staging.select(
        "Contract", F.col("TotalDuration").cast("string").alias("DurationText"),
        F.col("TotalDuration").cast("int").alias("DurationInt"),
        F.col("AppName").try_cast("bigint").alias("AppNumber"),
        F.substring("Contract", 2, 5).try_cast("bigint").alias("ContractNumber"))


@query
def fn_byte_length(f: Frames) -> DataFrame:
    typed = rows.with_category(f.staging).withColumn("Bytes", measures.byte_length("Type"))
    return typed.groupBy("Type", "Bytes").agg(F.count("*").alias("RowsCount"))


@query
def fn_regex_extract(f: Frames) -> DataFrame:
    dated = F.concat(F.lit("log_"), F.date_format("EventDate", "yyyyMMdd"), F.lit(".json"))
    return _by_day(f, FromName=calendar.day_from_name(dated), FromUndated=calendar.day_from_name(F.lit("log.json")))


# --- Dimensions and warehouse --------------------------------------------------------------


@query
def dim_date(f: Frames) -> DataFrame:
    counts = f.staging.groupBy(F.col("EventDate").alias("DateValue")).agg(F.count("*").alias("_n"))
    days = f.small.date.join(counts, "DateValue", "left")
    return days.withColumn("StagingRows", measures.or_zero("_n")).drop("_n")


@query
def dim_app(f: Frames) -> DataFrame:
    counts = f.staging.groupBy("AppName").agg(F.count("*").alias("_n"))
    return f.small.app.join(counts, "AppName", "left").withColumn("StagingRows", measures.or_zero("_n")).drop("_n")


@query
def dim_content_type(f: Frames) -> DataFrame:
    counts = mart.known_logs(f.staging).groupBy(F.col("AppCategory").alias("TypeName")).agg(F.count("*").alias("_n"))
    types = f.small.content_type.join(counts, "TypeName", "left")
    return types.withColumn("StagingRows", measures.or_zero("_n")).drop("_n")


@query
def dim_contract(f: Frames) -> DataFrame:
    return f.grown_contracts


@query
def surrogate_keys(f: Frames) -> DataFrame:
    ids = rows.complete(f.staging, "Mac").select(F.col("Mac").alias("MacAddress")).distinct()
    return keys.assign_keys(ids, "MacAddress", "Position")


@query
def dim_device(f: Frames) -> DataFrame:
    return f.grown_devices


@query
def load_warehouse(f: Frames) -> DataFrame:
    store = wh.warehouse_store(f.spark, scratch_path(f.spark, "warehouse"))
    wh.load_warehouse(f.spark, f.staging, store)
    return store.read(wh.FACTS)


def _loaded_table(f: Frames, name: str) -> DataFrame:
    """A warehouse table after a load of the first dates and one of all dates."""
    store = wh.warehouse_store(f.spark, scratch_path(f.spark, "warehouse"))
    wh.load_warehouse(f.spark, f.staging, store, ONE_DAY)
    wh.load_warehouse(f.spark, f.staging, store)
    return store.read(name)


@query
def load_warehouse_summary(f: Frames) -> DataFrame:
    loaded = _loaded_table(f, wh.SUMMARY)
    return mart.daily_summary(mart.with_calendar(loaded, f.small.date))


@query
def load_warehouse_members(f: Frames) -> DataFrame:
    """Contracts and devices after two loads; keys depend on the order of loads, members do not."""
    store = wh.warehouse_store(f.spark, scratch_path(f.spark, "warehouse"))
    wh.load_warehouse(f.spark, f.staging, store, ONE_DAY)
    wh.load_warehouse(f.spark, f.staging, store)
    contracts = store.read(wh.CONTRACTS).select(F.lit("contract").alias("Kind"), F.col("ContractID").alias("Member"))
    return contracts.unionByName(store.read(wh.DEVICES).select(F.lit("device").alias("Kind"), F.col("MacAddress").alias("Member")))


@query
def fact_contract_summary(f: Frames) -> DataFrame:
    return f.summary


# --- Marts ---------------------------------------------------------------------------------


@query
def mart_contract_analytics(f: Frames) -> DataFrame:
    return f.keyed_analytics


@query
def mart_daily_summary(f: Frames) -> DataFrame:
    return f.daily_from_logs


@query
def mart_content_trend(f: Frames) -> DataFrame:
    return f.trend_from_logs


@query
def mart_media_report(f: Frames) -> DataFrame:
    store = mart.media_store(f.spark, scratch_path(f.spark, "media"))
    mart.load_media_report(f.spark, f.staging, store)
    mart.load_media_report(f.spark, f.staging, store, ONE_DAY)
    return store.read(mart.MEDIA)


@query
def load_mart(f: Frames) -> DataFrame:
    warehouse, marts = f.loaded()
    mart.load_mart(f.spark, warehouse, marts, ONE_DAY)
    return marts.read(mart.ANALYTICS)


@query
def load_mart_daily(f: Frames) -> DataFrame:
    warehouse, marts = f.loaded()
    mart.load_mart(f.spark, warehouse, marts, ONE_DAY)
    return marts.read(mart.DAILY)


@query
def load_mart_trend(f: Frames) -> DataFrame:
    warehouse, marts = f.loaded()
    mart.load_mart(f.spark, warehouse, marts, ONE_DAY)
    return marts.read(mart.TREND)


@query
def refresh_late_and_corrected(f: Frames) -> DataFrame:
    """A load without the first days, one with a day that is later corrected, and the late days."""
    root = scratch_path(f.spark, "refreshed")
    staging, (store, marts) = pipeline.staging_folder(root), pipeline.stores(f.spark, root)
    late = F.col("EventDate") < F.lit(RANGE[0]).cast("date")
    wrong = f.staging.withColumn("EventDate", F.lit(RANGE[0]).cast("date")).limit(500)
    files.append_staging(f.staging.where(~late), staging, "main", mixed_dates=True)
    files.append_staging(wrong, staging, "corrected")
    pipeline.refresh(f.spark, root, None)
    files.append_staging(f.staging.where(late), staging, "late", mixed_dates=True)
    files.append_staging(f.staging.limit(0), staging, "corrected", files=["corrected"], checked=True)
    days = f.staging.where(late).select("EventDate").distinct().collect()
    pipeline.refresh(f.spark, root, sorted({row.EventDate for row in days} | {rows.as_date(RANGE[0])}))
    return marts.read(mart.ANALYTICS)


@query
def load_mart_behind(f: Frames) -> DataFrame:
    """Marts that take in two late loads at once, though the warehouse was folded between them."""
    store, marts = pipeline.stores(f.spark, scratch_path(f.spark, "behind"))
    early, late = f.days[:4], f.days[4:]
    wh.load_warehouse(f.spark, f.staging, store, process_dates=late)
    mart.catch_up(f.spark, store, marts)
    wh.load_warehouse(f.spark, f.staging, store, process_dates=early[:2])
    store.compact()
    wh.load_warehouse(f.spark, f.staging, store, process_dates=early[2:])
    mart.catch_up(f.spark, store, marts)
    return marts.read(mart.ANALYTICS)


@query
def refresh_resumed(f: Frames) -> DataFrame:
    """A refresh of the first days that ended after its warehouse load, and one of another day after it."""
    root = scratch_path(f.spark, "resumed")
    store, _ = pipeline.stores(f.spark, root)
    files.append_staging(f.staging, pipeline.staging_folder(root), "main", mixed_dates=True)
    pipeline.refresh(f.spark, root, f.days[4:])
    lost = Journal(f.spark, root).begin(f.days[:4])
    wh.load_warehouse(f.spark, f.staging, store, process_dates=lost)
    pipeline.refresh(f.spark, root, [rows.as_date(ONE_DAY)])
    return pipeline.committed(f.spark, root)[1].read(mart.ANALYTICS)


@query
def load_side_by_side(f: Frames) -> DataFrame:
    """Two mart loads of different days begun at once stay; a third of one of these days is refused."""
    _, marts = pipeline.stores(f.spark, scratch_path(f.spark, "together"))
    runs = [(marts.begin(), day) for day in (*f.days[:2], f.days[0])]
    for run, day in runs:
        run.write(mart.DAILY, f.daily.where(F.col("DateValue") == day))
        for name in (mart.ANALYTICS, mart.TREND):
            run.write(name, marts.read(name))
    for run, day in runs[:2]:
        run.publish(replaces=[day])
    try:
        runs[2][0].publish(replaces=[runs[2][1]])
    except Refused:
        return marts.read(mart.DAILY)
    raise AssertionError("a load of a day that was replaced meanwhile was published")


@query
def load_audited(f: Frames) -> DataFrame:
    """A load that keeps the rules of its tables, and one that breaks another rule and stays invisible."""
    lines = []
    for name, rules in (("kept", {}), ("broken", {wh.FACTS: (Rule("sessions are short", SHORT),)})):
        store = wh.warehouse_store(f.spark, scratch_path(f.spark, f"audited-{name}"), rules)
        broken: dict[tuple[str, str], int] = {}
        try:
            wh.load_warehouse(f.spark, f.staging, store, ONE_DAY)
        except RulesBroken as error:
            broken = error.broken
        said = [(name, *rule, count) for rule, count in broken.items()] or [(name, None, None, 0)]
        lines += [(*line, store.read(wh.FACTS).count()) for line in said]
    return f.spark.createDataFrame(
        lines, "Load string, TableName string, Rule string, RowsBroken bigint, RowsVisible bigint")


@query
def mart_clear(f: Frames) -> DataFrame:
    _, marts = f.loaded()
    counts = mart.clear_marts(marts)
    lines = [(name, counts["before"][name], counts["after"][name]) for name in counts["before"]]
    return f.spark.createDataFrame(lines, "TableName string, RowsBefore bigint, RowsAfter bigint")


@query
def contract_profile(f: Frames) -> DataFrame:
    return profile.contract_profile(f.staging)


@query
def run_pipeline(f: Frames) -> DataFrame:
    root = scratch_path(f.spark, "pipeline")
    pipeline.run_pipeline(f.spark, f.landing_paths, root)
    return pipeline.stores(f.spark, root)[1].read(mart.DAILY)


@query
def run_pipeline_range(f: Frames) -> DataFrame:
    """The landing files of a date range, from the names of their folders to the daily mart."""
    root = scratch_path(f.spark, "range")
    first, last = (day.replace("-", "") for day in RANGE)
    chosen = [path for path in f.undated_landing if first <= path[-8:] <= last]
    pipeline.run_pipeline(f.spark, chosen, root, level="folder")
    return pipeline.stores(f.spark, root)[1].read(mart.DAILY)


@query
def run_pipeline_media(f: Frames) -> DataFrame:
    root = scratch_path(f.spark, "pipeline")
    pipeline.run_pipeline(f.spark, f.landing_paths, root)
    return pipeline.media(f.spark, root).read(mart.MEDIA)


@query
def load_staging_undated(f: Frames) -> DataFrame:
    root = scratch_path(f.spark, "staging")
    pipeline.load_staging(f.spark, f.undated_landing, root, level="folder")
    return files.read_staging(f.spark, root)


@query
def load_staging_overlap(f: Frames) -> DataFrame:
    """Some files, then all of them: every row is there once."""
    root = scratch_path(f.spark, "staging")
    pipeline.load_staging(f.spark, f.landing_paths[:3], root)
    pipeline.load_staging(f.spark, f.landing_paths, root)
    return files.read_staging(f.spark, root)


@query
def load_staging(f: Frames) -> DataFrame:
    root = scratch_path(f.spark, "staging")
    pipeline.load_staging(f.spark, f.landing_paths, root)
    pipeline.load_staging(f.spark, f.landing_paths, root)
    return files.read_staging(f.spark, root)


@query
def staging_folded(f: Frames) -> DataFrame:
    """Parts of the log as loads that are merged two at a time; the first part is loaded wrongly at first."""
    root = scratch_path(f.spark, "folded")
    part = F.pmod(F.xxhash64("Contract"), F.lit(4))
    files.append_staging(f.staging.where(part == 1), root, "part0", mixed_dates=True, fan_in=2)
    for n in range(4):
        files.append_staging(f.staging.where(part == n), root, f"part{n}", mixed_dates=True, fan_in=2)
    return files.read_staging(f.spark, root)


@query
def staging_rejected(f: Frames) -> DataFrame:
    """Landing lines of which some are broken or hold no record: by contract what is staged, and what is rejected."""
    folder, root = scratch_path(f.spark, "lines"), scratch_path(f.spark, "staging")
    last = F.col("TotalDuration") % 10
    record = F.to_json(F.struct(F.struct("Contract", "Mac", "AppName", "TotalDuration").alias("_source")))
    lines = f.staging.select(
        F.when(last == 3, F.concat(F.lit('{"_source": '), "Contract"))
        .when(last == 4, F.concat(F.lit('{"other": "'), "Contract", F.lit('"}')))
        .otherwise(record))
    lines.write.text(folder)
    pipeline.load_staging(f.spark, [folder], root, run_date=ONE_DAY)
    staged = files.read_staging(f.spark, root).select(
        F.lit(None).cast("string").alias("Reason"), F.col("Contract").alias("Line"))
    rejected = files.read_rejected(f.spark, root).select("Reason", "Line")
    return staged.unionByName(rejected).groupBy("Reason", "Line").agg(F.count("*").alias("Lines"))


@query
def run_with_checks(f: Frames) -> DataFrame:
    store = wh.warehouse_store(f.spark, scratch_path(f.spark, "checked"))
    before, after = pipeline.run_with_checks(f.spark, f.staging, store)
    dates = {name: calendar.date_key(name).cast("bigint") for name in ("MinDate", "MaxDate")}
    sides = [before.withColumns(dates), after]
    return rows.union_by_name(*[side.unpivot([], side.columns, "CheckName", "CheckValue") for side in sides])


# --- Reports -------------------------------------------------------------------------------


@query
def kpi_7d(f: Frames) -> DataFrame:
    return report.kpis(f.daily, AS_OF)


@query
def daily_hours_7d(f: Frames) -> DataFrame:
    return report.daily_hours(f.daily, AS_OF)


@query
def daily_table(f: Frames) -> DataFrame:
    return report.daily_table(f.daily, *RANGE)


@query
def distribution_from_daily(f: Frames) -> DataFrame:
    return report.distribution_of_range(f.daily, *RANGE)


@query
def contract_leaderboard(f: Frames) -> DataFrame:
    return report.contract_leaderboard(f.analytics, AS_OF)


@query
def trend_30d(f: Frames) -> DataFrame:
    return report.trend(f.trend, AS_OF)


@query
def daily_duration_30d(f: Frames) -> DataFrame:
    return report.daily_duration(f.daily, AS_OF)


@query
def distribution_30d(f: Frames) -> DataFrame:
    return report.distribution_trailing(f.daily, AS_OF)


@query
def top10_contracts_30d(f: Frames) -> DataFrame:
    return report.top_contracts(f.analytics, AS_OF)


@query
def contract_series(f: Frames) -> DataFrame:
    return report.contract_series(f.analytics, AS_OF, contract=None)


@query
def contract_details(f: Frames) -> DataFrame:
    return report.contract_details(f.analytics, AS_OF)


@query
def contract_list(f: Frames) -> DataFrame:
    return report.contract_list(f.analytics)


@query
def type_comparison(f: Frames) -> DataFrame:
    return report.type_comparison(f.trend, AS_OF)


@query
def type_statistics(f: Frames) -> DataFrame:
    return report.type_statistics(f.trend, AS_OF)


@query
def realtime_daily(f: Frames) -> DataFrame:
    return report.realtime_daily(f.daily, AS_OF)


@query
def realtime_types(f: Frames) -> DataFrame:
    return report.realtime_types(f.trend, AS_OF)


# --- Rollups -------------------------------------------------------------------------------


@query
def rollup_leaderboard(f: Frames) -> DataFrame:
    _, marts = pipeline.stores(f.spark, f.rolled_up)
    first = calendar_day(AS_OF, -30)
    return report.leaderboard(rollups.contract_window(marts, pipeline.rolled_up(f.spark, f.rolled_up), first))


@query
def rollup_details(f: Frames) -> DataFrame:
    _, marts = pipeline.stores(f.spark, f.rolled_up)
    first = calendar_day(AS_OF, -29)
    return report.details(rollups.contract_window(marts, pipeline.rolled_up(f.spark, f.rolled_up), first))


@query
def active_contracts(f: Frames) -> DataFrame:
    """Different contracts per category of a window that begins and ends within weeks."""
    store, _ = pipeline.stores(f.spark, f.rolled_up)
    window = rollups.active_window(f.spark, store, pipeline.rolled_up(f.spark, f.rolled_up), *RANGE)
    return rollups.counted(window, "ContentType")


@query
def active_contracts_by_period(f: Frames) -> DataFrame:
    """Different contracts of every day, week and month, from refreshed rollups."""
    rolled = pipeline.rolled_up(f.spark, f.rolled_up)
    rollups.refresh(f.spark, *pipeline.stores(f.spark, f.rolled_up), rolled)
    return rows.union_by_name(*[
        rollups.active_periods(rolled, level).select(F.lit(level).alias("Level"), "*") for level in rollups.ACTIVE])


@query
def partial_distinct(f: Frames) -> DataFrame:
    """Different contracts per day and category from the states of four parts of the log, one of them replaced."""
    by = ("Part", "DateKey", "ContentTypeKey")
    facts = f.stored_facts.withColumn("Part", F.pmod("DeviceKey", F.lit(4)))
    states = f.written("states", rollups.active_state(facts.where(f"Part <> 1 OR {SHORT}"), *by))
    again = rollups.active_state(facts.where("Part = 1"), *by)
    return rollups.counted(states.where("Part <> 1").unionByName(again), *by[1:])


# --- The same jobs on the larger log derived from orders -----------------------------------


@query
def contract_profile_orders(f: Frames) -> DataFrame:
    return profile.contract_profile(f.order_log, "en")


@query
def media_report_orders(f: Frames) -> DataFrame:
    return aggregates.media_report(f.order_log)


@query
def mart_daily_summary_orders(f: Frames) -> DataFrame:
    return mart.daily_summary(mart.days_from_logs(f.order_log))


@query
def contract_leaderboard_orders(f: Frames) -> DataFrame:
    days = mart.with_first_day(mart.days_from_logs(f.order_log), "ContractID")
    return report.contract_leaderboard(mart.contract_analytics(days), ORDERS_AS_OF, n=50, days=ORDERS_DAYS)


# --- Data quality --------------------------------------------------------------------------


@query
def dq_staging_profile(f: Frames) -> DataFrame:
    return quality.staging_profile(f.staging)


@query
def dq_dim_counts(f: Frames) -> DataFrame:
    return aggregates.table_counts(
        DimDate=f.small.date, DimApp=f.small.app, DimContentType=f.small.content_type,
        DimContract=f.contracts, DimDevice=f.devices)


@query
def dq_day_profile(f: Frames) -> DataFrame:
    return quality.day_profile(f.staging, ONE_DAY)


@query
def dq_app_match(f: Frames) -> DataFrame:
    return quality.app_match(f.staging, f.small)


@query
def dq_category_match(f: Frames) -> DataFrame:
    return quality.category_match(f.staging, f.small)


@query
def dq_date_match(f: Frames) -> DataFrame:
    return quality.date_match(f.staging, f.small)


@query
def dq_joinable_rows(f: Frames) -> DataFrame:
    return quality.joinable_rows(f.grain, f.small, f.early_contracts, f.early_devices)


@query
def dq_unjoinable(f: Frames) -> DataFrame:
    return quality.unjoinable(f.grain, f.small, f.early_contracts, f.early_devices)


@query
def dq_top_apps(f: Frames) -> DataFrame:
    return quality.top_apps(f.staging, f.small)


@query
def dq_fact_range(f: Frames) -> DataFrame:
    return quality.fact_range(f.facts)


@query
def dq_summary_for_day(f: Frames) -> DataFrame:
    return quality.summary_for_day(f.summary, f.small.date, ONE_DAY)


@query
def dq_complete_rows(f: Frames) -> DataFrame:
    return quality.complete_rows(f.staging, ONE_DAY)


@query
def dq_new_keys(f: Frames) -> DataFrame:
    return quality.new_keys(f.staging, f.early_contracts, f.early_devices, ONE_DAY)


@query
def dq_unique(f: Frames) -> DataFrame:
    return quality.unique_checks(f.small, f.contracts, f.devices, f.daily)


@query
def dq_foreign_keys(f: Frames) -> DataFrame:
    return quality.foreign_key_checks(
        f.stored_facts, f.stored_summary, f.small, f.early_contracts, f.early_devices)


@query
def dq_not_null(f: Frames) -> DataFrame:
    return rows.union_by_name(
        quality.not_null_checks(f.stored_facts, f.analytics),
        quality.missing_values(f.staging, "staging", *schema.STAGING.names))


# --- Streaming -----------------------------------------------------------------------------


@query
def stream_refresh(f: Frames) -> DataFrame:
    root = scratch_path(f.spark, "stream-refresh")
    jobs.ingest_and_refresh(f.spark, f.landing, root, f"{root}/checkpoint", level="folder")
    return pipeline.committed(f.spark, root)[1].read(mart.ANALYTICS)


@query
def incremental_ingest(f: Frames) -> DataFrame:
    root = scratch_path(f.spark, "stream")
    jobs.ingest_new_files(f.spark, f.landing, f"{root}/staging", f"{root}/checkpoint", level="folder")
    return files.read_staging(f.spark, f"{root}/staging")


@query
def live_daily_totals(f: Frames) -> DataFrame:
    root = scratch_path(f.spark, "live")
    # A stream wants a folder or a pattern; this pattern fits the table alone, be it a file or a folder of files.
    stream = f.spark.readStream.schema(f.events.schema).parquet(f"{f.sf_dir}/events.parque[t]")
    jobs.write_daily_totals(jobs.daily_totals(adapter.log_from_events(stream)), f"{root}/totals", f"{root}/checkpoint")
    return jobs.read_daily_totals(f.spark, f"{root}/totals").drop("ApproxContracts")
