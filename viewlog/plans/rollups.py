"""Rollups by day, week and month, of which few pieces cover any window of dates.

Two kinds are kept below one root, and both merge exactly.

* Per contract and week or month: sums and largest values of its rows in the analytics mart, whose rows are
  the days. A leaderboard over a year reads twelve rows of a contract instead of 365.
* Per category and day, week or month: seconds, sessions and which contracts were active, one bit per contract
  key. The keys are dense, so a bitmap of 4 KB holds 32,768 contracts. Distinct counts of days cannot be added
  up; their bitmaps can be united, by any grouping and in any order, and no contract is shuffled for that.

The rollups note how far they have read the logs of warehouse and marts. ``refresh`` rebuilds the periods that
hold a date loaded since. Readers take no period with such a date, but its days from the stores themselves, so
a window is right whether or not the rollups have been refreshed.
"""

from __future__ import annotations

import calendar as months
from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.operators import rows
from viewlog.operators.states import active_state, counted, merged_state
from viewlog.plans import mart
from viewlog.plans import warehouse as wh
from viewlog.session import together
from viewlog.sinks.versioned import Run, Table, VersionedStore, given

LEVELS = ("month", "week")  # the larger first; days are what both are made of
CONTRACTS = {level: f"rollup_contract_{level}" for level in LEVELS}
ACTIVE = {level: f"rollup_active_{level}" for level in ("day", *LEVELS)}
WAREHOUSE, MARTS = "warehouse", "marts"  # the names under which the places in their logs are noted

TABLES = (
    *(Table(name, schema.ROLLUP_CONTRACT, dated_by="PeriodStart", sort_by=("ContractID",),
            rules=given("PeriodStart", "ContractID")) for name in CONTRACTS.values()),
    *(Table(name, schema.ROLLUP_ACTIVE, dated_by="PeriodStart",
            rules=given("PeriodStart", "ContentType", "Bucket", "Contracts")) for name in ACTIVE.values()),
)

# Of the text columns, all values in ascending order.
_TEXTS = {"MostWatchContentType": sorted(schema.category_labels()), "ActivationLevel": sorted(schema.SINCE_FIRST_LEVELS)}
_LARGEST = ("ActivationDays", *_TEXTS)
_ADDED = tuple(name for name in schema.ROLLUP_CONTRACT.names if name not in ("PeriodStart", "ContractID", *_LARGEST))


def rollup_store(spark: SparkSession, root: str) -> VersionedStore:
    return VersionedStore(spark, root, TABLES)


# --- Periods -------------------------------------------------------------------------------


def start_of(level: str, day: date) -> date:
    """The first day of the month or the week, which begins on Monday."""
    return day.replace(day=1) if level == "month" else day - timedelta(days=day.weekday())


def days_of(level: str, start: date) -> list[date]:
    size = months.monthrange(start.year, start.month)[1] if level == "month" else 7
    return [start + timedelta(days=n) for n in range(size)]


def pieces(first: date, last: date, changed: Iterable[date] = ()) -> dict[str, list[date]]:
    """Whole months, then whole weeks, then days that make up a window, by their first days.

    No month or week holds a day of ``changed``. Each day of the window lies in one piece.
    """
    left = {first + timedelta(days=n) for n in range((last - first).days + 1)}
    found: dict[str, list[date]] = {}
    for level in LEVELS:
        found[level] = [
            start for start in sorted({start_of(level, day) for day in left})
            if left.issuperset(days_of(level, start)) and set(changed).isdisjoint(days_of(level, start))]
        left.difference_update(day for start in found[level] for day in days_of(level, start))
    return found | {"day": sorted(left)}


def _period(level: str) -> Column:
    return F.trunc("DateValue", level)


# --- States that merge ---------------------------------------------------------------------


def merged_contracts(days: DataFrame, *by: str | Column) -> DataFrame:
    """Rows of contracts added up per group; the text columns are the largest values, as in the reports.

    Texts are compared by their places among all values: the largest text would need every row to be sorted.
    """
    merged = days.withColumns({name: _place(name) for name in _TEXTS}).groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in _ADDED], *[F.max(name).alias(name) for name in _LARGEST])
    return merged.withColumns({name: F.get(_texts(name), (F.col(name) - 1).cast("int")) for name in _TEXTS})


def contract_periods(days: DataFrame) -> DataFrame:
    """Rows of contracts added up per week and per month, ``Level`` telling which.

    The days are read and shuffled once: what a week and a month share is added up first, and goes to both.
    A contract has no more rows than the calendar has days, so none burdens a task.
    """
    shared = merged_contracts(
        days.repartition("ContractID"), *[_period(level).alias(level) for level in LEVELS], "ContractID")
    starts = F.array(*[F.struct(F.lit(level).alias("Level"), F.col(level).alias("PeriodStart")) for level in LEVELS])
    return merged_contracts(shared.select("*", F.inline(starts)), "Level", "PeriodStart", "ContractID")


def _texts(name: str) -> Column:
    return F.array(*[F.lit(text) for text in _TEXTS[name]])


def _place(name: str) -> Column:
    place = F.array_position(_texts(name), F.col(name))
    return F.when(place == 0, F.raise_error(F.concat(F.lit(f"unknown {name}: "), F.col(name)))).otherwise(place)


# --- Load ----------------------------------------------------------------------------------


def changed_dates(store: VersionedStore, rollups: VersionedStore, name: str) -> list[date] | None:
    """The dates a store has loaded since the rollups read it; None meaning every date."""
    loads = store.loads_since(rollups.taken(name))
    if not rollups.position() or any(load.dates is None for load in loads):
        return None
    return sorted({day for load in loads for day in load.dates})


def refresh(
    spark: SparkSession, warehouse: VersionedStore, marts: VersionedStore, rollups: VersionedStore,
    calendar_range: tuple[str, str] = schema.CALENDAR,
) -> dict[str, int]:
    """Rebuild the weeks and months that hold a date loaded since the last time; nothing if none was.

    Sessions are read for those dates only: the bitmaps of weeks and months unite those of their days.
    All tables become visible at once. Of two refreshes at the same time one is refused.
    """
    warehouse, marts = warehouse.snapshot(), marts.snapshot()
    changed = [changed_dates(warehouse, rollups, WAREHOUSE), changed_dates(marts, rollups, MARTS)]
    if changed == [[], []]:
        return {table.name: 0 for table in TABLES}
    starts = None
    if None not in changed:
        dates = {day for found in changed for day in found}
        starts = sorted(dates | {start_of(level, day) for level in LEVELS for day in dates})
    run = rollups.begin()
    begun = {level: None if starts is None else [day for day in starts if day == start_of(level, day)] for level in LEVELS}
    inside = {level: None if begun[level] is None else [day for start in begun[level] for day in days_of(level, start)]
              for level in LEVELS}

    def active() -> None:
        run.write(ACTIVE["day"], _active_days(spark, warehouse, starts, calendar_range))
        together(spark, *[partial(active_periods_of, level) for level in LEVELS])

    def active_periods_of(level: str) -> None:
        days = rows.on_dates(_all_days(run, starts), inside[level], "DateValue")
        run.write(ACTIVE[level], merged_state(days, _period(level).alias("PeriodStart"), "ContentType"))

    def contracts() -> None:
        wanted = None if starts is None else sorted({day for level in LEVELS for day in inside[level]})
        days = rows.on_dates(marts.read(mart.ANALYTICS), wanted, "DateValue")
        periods = run.scratch("contract_periods", contract_periods(days), schema.ROLLUP_LEVELS)
        together(spark, *[partial(contract_periods_of, level, periods) for level in LEVELS])

    def contract_periods_of(level: str, periods: DataFrame) -> None:
        run.write(CONTRACTS[level], rows.on_dates(periods.where(F.col("Level") == level), begun[level], "PeriodStart"))

    together(spark, active, contracts)
    run.publish(replaces=starts, taken={WAREHOUSE: warehouse.position(), MARTS: marts.position()})
    return run.counts


def _active_days(
    spark: SparkSession, warehouse: VersionedStore, dates: Sequence[date] | None, calendar_range: tuple[str, str]
) -> DataFrame:
    """Activity of the given dates, from the facts."""
    facts = mart.on_keys(warehouse.read(wh.FACTS), dates)
    found = active_state(facts, "DateKey", "ContentTypeKey")
    return mart.trend_rows(found, wh.SmallDims.build(spark, calendar=calendar_range)).withColumnRenamed("DateValue", "PeriodStart")


def _all_days(run: Run, replaced: list[date] | None) -> DataFrame:
    """Activity of all days as this run leaves them."""
    own = run.read(ACTIVE["day"])
    if replaced is not None:
        own = own.unionByName(run.before(ACTIVE["day"]).where(~F.col("PeriodStart").isin(replaced)))
    return own.withColumnRenamed("PeriodStart", "DateValue")


# --- Windows -------------------------------------------------------------------------------


def _window(
    store: VersionedStore, rollups: VersionedStore, name: str, first: date | str, last: date | str
) -> tuple[dict[str, list[date]], list[date]]:
    """The pieces of a window, and those of its days that the rollups do not hold as the store does."""
    first, last = rows.as_date(first), rows.as_date(last)
    changed = changed_dates(store, rollups, name)
    if changed is None or rollups.taken(name) > store.position():
        changed = pieces(first, last, [first + timedelta(days=n) for n in range((last - first).days + 1)])["day"]
    found = pieces(first, last, changed)
    return found, sorted({*found["day"]} & {*changed})


def contract_window(
    marts: VersionedStore, rollups: VersionedStore, first: date | str, last: date | str = schema.CALENDAR_END
) -> DataFrame:
    """Rows of contracts that make up a window, for ``report.leaderboard`` and the like.

    Their sums and largest values per contract are those of its rows in the mart.
    """
    marts, rollups = marts.snapshot(), rollups.snapshot()
    found, _ = _window(marts, rollups, MARTS, first, last)
    out = rows.on_dates(marts.read(mart.ANALYTICS), found["day"], "DateValue").withColumnRenamed(
        "DateValue", "PeriodStart").select(*schema.ROLLUP_CONTRACT.names)
    for level in LEVELS:
        if found[level]:
            out = out.unionByName(rows.on_dates(rollups.read(CONTRACTS[level]), found[level], "PeriodStart"))
    return out


def active_window(
    spark: SparkSession, warehouse: VersionedStore, rollups: VersionedStore, first: date | str,
    last: date | str = schema.CALENDAR_END, calendar_range: tuple[str, str] = schema.CALENDAR,
) -> DataFrame:
    """States of the pieces that make up a window, for ``counted``."""
    warehouse, rollups = warehouse.snapshot(), rollups.snapshot()
    found, changed = _window(warehouse, rollups, WAREHOUSE, first, last)
    fresh = sorted({*found["day"]} - {*changed})
    out = _active_days(spark, warehouse, changed, calendar_range).select(*schema.ROLLUP_ACTIVE.names)
    for level, starts in (("day", fresh), *((level, found[level]) for level in LEVELS)):
        if starts:
            out = out.unionByName(rows.on_dates(rollups.read(ACTIVE[level]), starts, "PeriodStart"))
    return out


def active_periods(rollups: VersionedStore, level: str) -> DataFrame:
    """Seconds, sessions and different contracts of every day, week or month: of all categories together."""
    return counted(rollups.read(ACTIVE[level]), "PeriodStart")
