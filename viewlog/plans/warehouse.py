"""Star schema: facts from staging, and the job that loads them."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import measures
from viewlog.operators import aggregates, rows
from viewlog.plans import dims
from viewlog.session import together
from viewlog.sinks.versioned import Rule, Run, Table, VersionedStore, given

FACTS = "fact_viewing_session"
SUMMARY = "fact_contract_summary"
CONTRACTS = "dim_contract"
DEVICES = "dim_device"
FIRST = "contract_first_date"

# Which columns are always given, which values occur once and which keys point to members is fixed by the schema.
TABLES = (
    Table(CONTRACTS, schema.DIM_CONTRACT, rules=given("ContractID"), key="ContractKey", unique=("ContractID",)),
    Table(DEVICES, schema.DIM_DEVICE, rules=given("MacAddress"), key="DeviceKey", unique=("MacAddress",),
          references=(("ContractKey", CONTRACTS),)),
    Table(FACTS, schema.FACT_VIEWING_SESSION, dated_by="DateKey",
          rules=given("DateKey", "AppKey", "ContentTypeKey", "TotalDuration", "SessionCount"),
          references=(("ContractKey", CONTRACTS), ("DeviceKey", DEVICES))),
    Table(SUMMARY, schema.FACT_CONTRACT_SUMMARY, dated_by="DateKey",
          rules=given("DateKey", "TotalDevices", "TotalDuration_All"), references=(("ContractKey", CONTRACTS),)),
    Table(FIRST, schema.FIRST_DATE, references=(("ContractKey", CONTRACTS),),
          fold=lambda changes: newest_changes(changes).where(F.col("FirstDateKey").isNotNull())),
)


def warehouse_store(
    spark: SparkSession, root: str, rules: dict[str, tuple[Rule, ...]] | None = None
) -> VersionedStore:
    """The warehouse below a folder; ``rules`` adds rules to those of its tables, by table name."""
    more = rules or {}
    return VersionedStore(spark, root, [replace(table, rules=(*table.rules, *more.get(table.name, ()))) for table in TABLES])


@dataclass(frozen=True)
class SmallDims:
    """The fixed-size dimensions: calendar, applications and categories. Always broadcast."""

    date: DataFrame
    app: DataFrame
    content_type: DataFrame

    @classmethod
    def build(
        cls, spark: SparkSession, unknown: str = "drop", calendar: tuple[str, str] = schema.CALENDAR
    ) -> SmallDims:
        return cls(dims.dim_date(spark, *calendar), dims.dim_app(spark, unknown), dims.dim_content_type(spark))


def join_small_dims(logs: DataFrame, small: SmallDims) -> DataFrame:
    """Log rows with calendar, application and category keys.

    The calendar is matched on the date itself, so a date filter reaches the staging partitions.
    Rows with a date outside the calendar, or an unlisted application, drop out.
    """
    days = small.date.select("DateKey", F.col("DateValue").alias("EventDate"))
    types = small.content_type.select("ContentTypeKey", F.col("TypeName").alias("AppCategory"))
    apps = small.app.join(F.broadcast(types), "AppCategory")
    return logs.join(F.broadcast(days), "EventDate").join(F.broadcast(apps), "AppName")


def star_join(grain: DataFrame, small: SmallDims, pairs: DataFrame) -> DataFrame:
    """Session-grain rows with the keys of all five dimensions; rows that miss any of them drop out.

    ``pairs`` gives contract and device key together, so the sessions are shuffled once. A pair has
    at most one session row per calendar day and listed application, so none can be lopsided.
    """
    return join_small_dims(rows.complete(grain, "Contract", "Mac"), small).join(pairs, ["Contract", "Mac"])


def fact_viewing_session(grain: DataFrame, small: SmallDims, pairs: DataFrame) -> DataFrame:
    """Seconds and sessions per date, contract, device, application and category.

    Natural and surrogate keys correspond one to one, so rows already at session grain need no
    second aggregation after the joins.
    """
    return star_join(grain, small, pairs).select(
        "DateKey", "ContractKey", "DeviceKey", "AppKey", "ContentTypeKey",
        measures.or_zero("TotalDuration").alias("TotalDuration"), "SessionCount",
    )


def turned_away(grain: DataFrame, small: SmallDims) -> dict[str, int]:
    """Sessions that do not reach the facts, by the dimension that lacks their value, from one pass."""
    known_days = small.date.select(F.col("DateValue").alias("EventDate"), F.lit(True).alias("_day"))
    known_apps = small.app.select("AppName", F.lit(True).alias("_app"))
    rows = grain.join(F.broadcast(known_days), "EventDate", "left").join(F.broadcast(known_apps), "AppName", "left")
    missing = {"Date": F.col("_day"), "App": F.col("_app"), "Contract": F.col("Contract"), "Device": F.col("Mac")}
    sums = [F.sum(F.when(value.isNull(), F.col("SessionCount"))).alias(name) for name, value in missing.items()]
    return {f"TurnedAway{name}": count or 0 for name, count in rows.agg(*sums).first().asDict().items()}


def fact_contract_summary(facts: DataFrame, small: SmallDims) -> DataFrame:
    """Devices and seconds per category of every contract and day.

    Facts carry the keys already, so only the category name has to be joined in.
    """
    types = small.content_type.select("ContentTypeKey", F.col("TypeName").alias("Type"))
    return aggregates.contract_days(
        facts.join(F.broadcast(types), "ContentTypeKey"), "DateKey", "ContractKey",
        kind="Type", device="DeviceKey", prefix="TotalDuration", total="All")


def first_dates(store: VersionedStore) -> DataFrame:
    """The first date key of every contract that has one: ContractKey, FirstDateKey."""
    return _newest_first(store.read(FIRST, with_run=True))


def change_run() -> Column:
    """The run that made a change, folded or not."""
    return F.coalesce("ChangeRun", "run")


def newest_changes(changes: DataFrame) -> DataFrame:
    """The newest change of every contract, with the run that made it."""
    made = F.struct("FirstDateKey", "WasDateKey", change_run().alias("ChangeRun"))
    return changes.groupBy("ContractKey").agg(F.max_by(made, "run").alias("_newest")).select("ContractKey", "_newest.*")


def _newest_first(changes: DataFrame) -> DataFrame:
    newest = changes.groupBy("ContractKey").agg(F.max_by("FirstDateKey", "run").alias("FirstDateKey"))
    return newest.where(F.col("FirstDateKey").isNotNull())


def first_date_changes(run: Run, dates: list[date] | None) -> DataFrame:
    """Contracts whose first date this run changes, with the new one and the one before.

    Loaded dates can bring a first date forward without a look at any other date. The history is read
    for those contracts only whose first date was among the loaded ones and is gone from it.
    """
    loaded = run.read(SUMMARY).groupBy("ContractKey").agg(F.min("DateKey").alias("_loaded"))
    before = _newest_first(run.before(FIRST, with_run=True)).withColumnRenamed("FirstDateKey", "WasDateKey")
    both = loaded.join(before, "ContractKey", "full")
    if dates is None:
        moved = both.withColumn("FirstDateKey", F.col("_loaded"))
    else:
        keys = [int(f"{day:%Y%m%d}") for day in dates]
        lost = F.col("WasDateKey").isin(keys) & ~F.coalesce(F.col("_loaded") <= F.col("WasDateKey"), F.lit(False))
        gone = both.where(lost).select("ContractKey")
        rest = run.before(SUMMARY).where(~F.col("DateKey").isin(keys)).join(gone, "ContractKey", "left_semi")
        rest = rest.groupBy("ContractKey").agg(F.min("DateKey").alias("_rest"))
        moved = both.join(rest, "ContractKey", "left").withColumn(
            "FirstDateKey", F.when(lost, F.least("_loaded", "_rest")).otherwise(F.least("_loaded", "WasDateKey")))
    changed = moved.where(~F.col("FirstDateKey").eqNullSafe(F.col("WasDateKey")))
    return changed.withColumn("ChangeRun", F.lit(None).cast("int")).select(*schema.FIRST_DATE.names)


def load_warehouse(
    spark: SparkSession,
    staging: DataFrame,
    store: VersionedStore,
    process_date: date | str | None = None,
    unknown: str = "drop",
    process_dates: list[date] | None = None,
    calendar: tuple[str, str] = schema.CALENDAR,
) -> dict[str, int]:
    """Load the star schema from staging, for all dates or the given ones.

    Dimensions only gain members; facts and summaries of the loaded dates are replaced, so loading
    a date again changes nothing. Everything is written under a new run number and becomes visible
    in one step at the end, if no row breaks a rule. A load of other dates at the same time makes this
    one begin again, one of the same dates refuses it. ``calendar`` gives the first and last day of the
    date dimension. Returns the rows written per table, and the sessions that each dimension turned away.
    """
    small = SmallDims.build(spark, unknown, calendar)
    if process_date is not None:
        process_dates = [rows.as_date(process_date)]
    logs = rows.on_dates(staging, process_dates)
    if unknown == "error":
        logs = logs.withColumn("AppName", measures.known_app_or_other("AppName"))

    def load(run: Run) -> None:
        grain = run.scratch("session_grain", aggregates.session_grain(logs), schema.SESSION_GRAIN)
        together(spark, lambda: load_facts(run, grain), lambda: turned.update(turned_away(grain, small)))
        run.publish(replaces=process_dates)

    def load_facts(run: Run, grain: DataFrame) -> None:
        seen = run.scratch("seen_pairs", dims.seen_pairs(grain), schema.SEEN_PAIRS)
        run.write(CONTRACTS, dims.new_contracts(seen, run.before(CONTRACTS)))
        contracts = run.before(CONTRACTS).unionByName(run.read(CONTRACTS))
        owned = run.scratch("owned_pairs", dims.owned_pairs(seen, contracts), schema.OWNED_PAIRS)
        run.write(DEVICES, dims.new_devices(owned, run.before(DEVICES)))
        devices = run.before(DEVICES).unionByName(run.read(DEVICES))
        run.write(FACTS, fact_viewing_session(grain, small, dims.pair_keys(owned, devices)))
        run.write(SUMMARY, fact_contract_summary(run.read(FACTS), small))
        run.write(FIRST, first_date_changes(run, process_dates))

    turned: dict[str, int] = {}
    return store.load(load).counts | turned
