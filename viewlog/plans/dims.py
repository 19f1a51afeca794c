"""Dimension tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import calendar
from viewlog.operators import joins, keys


def dim_date(spark: SparkSession, start: str = schema.CALENDAR_START, end: str = schema.CALENDAR_END) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    day = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    return calendar.with_calendar_columns(
        spark.range(0, days, 1, numPartitions=1).select(day.alias("DateValue"))
    ).select(
        "DateKey", "DateValue", "Year", "Quarter", "Month", "MonthName", "Day",
        F.dayofweek("DateValue").alias("DayOfWeek"),
        calendar.day_name("DateValue").alias("DayName"),
        calendar.is_weekend("DateValue").alias("IsWeekend"),
    )


def _listing(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small constant table, known to the optimizer as literal rows."""
    values = ", ".join("(" + ", ".join(repr(value) for value in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def dim_app(spark: SparkSession, unknown: str = "drop") -> DataFrame:
    """Listed applications with their category; ``unknown="error"`` adds the placeholder member 0."""
    apps = [(app, c.label) for c in schema.CATEGORIES for app in c.apps]
    rows = [(n, app, label) for n, (app, label) in enumerate(apps, start=1)]
    if unknown == "error":
        rows.append((0, schema.OTHER_APP, schema.UNKNOWN.label))
    elif unknown != "drop":
        raise ValueError(f"unknown must be 'drop' or 'error', not {unknown!r}")
    return _listing(spark, rows, ["AppKey", "AppName", "AppCategory"])


def dim_content_type(spark: SparkSession) -> DataFrame:
    rows = [(n, c.label, c.description) for n, c in enumerate(schema.ALL_CATEGORIES, start=1)]
    return _listing(spark, rows, ["ContentTypeKey", "TypeName", "Description"])


def seen_pairs(rows: DataFrame) -> DataFrame:
    """Every contract with every device it was seen with, NULL among them: all that the dimensions need of ``rows``."""
    return rows.where(F.col("Contract").isNotNull()).select("Contract", "Mac").distinct()


def new_contracts(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Contracts in ``rows`` that the dimension lacks, with keys that continue after its largest."""
    ids = rows.where(F.col("Contract").isNotNull()).select(F.col("Contract").alias("ContractID")).distinct()
    if existing is not None:
        ids = joins.not_in(ids, existing, "ContractID", "ContractID")
    return keys.assign_keys(ids, "ContractID", "ContractKey", existing).select("ContractKey", "ContractID")


def owned_pairs(rows: DataFrame, contracts: DataFrame) -> DataFrame:
    """Every (contract, device) pair that occurs, with the contract's key.

    A contract that nearly every device appears under is spread by the device. Heavy contracts are
    told by their rows: a contract has no more pairs than rows, so one that is not heavy stays small.
    """
    heavy = joins.heavy_keys(rows, "Contract")
    pairs = rows.where(F.col("Mac").isNotNull() & F.col("Contract").isNotNull()).select("Contract", "Mac").distinct()
    return joins.lookup(pairs, contracts, "Contract", "ContractID", heavy, spread=["Mac"])


def first_contract_of_device(owned: DataFrame) -> DataFrame:
    """Smallest contract key each device was seen under."""
    return owned.groupBy(F.col("Mac").alias("MacAddress")).agg(F.min("ContractKey").alias("ContractKey"))


def new_devices(owned: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Devices the dimension lacks. A device that is already there keeps its first contract."""
    owners = first_contract_of_device(owned)
    if existing is not None:
        owners = joins.not_in(owners, existing, "MacAddress", "MacAddress")
    keyed = keys.assign_keys(owners, "MacAddress", "DeviceKey", existing)
    return keyed.select("DeviceKey", "MacAddress", "ContractKey")


def pair_keys(owned: DataFrame, devices: DataFrame) -> DataFrame:
    """Contract and device key of every pair; a device under very many contracts is spread by contract."""
    heavy = joins.heavy_keys(owned, "Mac")
    keyed = devices.select("DeviceKey", "MacAddress")
    return joins.lookup(owned, keyed, "Mac", "MacAddress", heavy, spread=["Contract"])


def grown(existing: DataFrame | None, added: DataFrame) -> DataFrame:
    return added if existing is None else existing.unionByName(added)
