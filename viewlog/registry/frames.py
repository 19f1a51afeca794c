"""Frames the registered queries share: the log adapter and the tables built from it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.operators import aggregates
from viewlog.plans import dims, mart, pipeline, rollups
from viewlog.plans import warehouse as wh
from viewlog.session import scratch_path
from viewlog.sinks import files
from viewlog.sinks.versioned import VersionedStore
from viewlog.sources import adapter

AS_OF = "2024-01-30"  # last date of the adapter
LOADED_BEFORE = "2024-01-02"  # earlier dates count as loaded when increments are tested
ONE_DAY = "2024-01-16"
RANGE = ("2024-01-05", "2024-01-20")
ONE_CONTRACT = "C00007"
SHORT = "TotalDuration < 3600"  # a rule that some session breaks
ORDERS_AS_OF = "2028-12-31"
ORDERS_DAYS = 3650  # reaches back before the first order line

_published: dict[tuple[str, str], str] = {}


@dataclass
class Frames:
    """Frames of one data folder, each built on first use."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")

    @cached_property
    def staging(self) -> DataFrame:
        return adapter.log_from_events(self.events)

    @cached_property
    def days(self) -> list[date]:
        """The dates of the log: one per calendar day at most."""
        return [row.EventDate for row in self.staging.select("EventDate").distinct().orderBy("EventDate").collect()]

    @cached_property
    def order_log(self) -> DataFrame:
        tables = [self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet") for name in ("lineitem", "orders")]
        return adapter.log_from_orders(*tables)

    @cached_property
    def small(self) -> wh.SmallDims:
        return wh.SmallDims.build(self.spark)

    def written(self, name: str, frame: DataFrame) -> DataFrame:
        """A frame stored in the shared folder, for the plans that use it several times."""
        path = scratch_path(self.spark, name)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    # Star schema with surrogate keys

    @cached_property
    def grain(self) -> DataFrame:
        return self.written("grain", aggregates.session_grain(self.staging))

    @cached_property
    def contracts(self) -> DataFrame:
        return self.written("contracts", dims.new_contracts(self.grain))

    @cached_property
    def owned(self) -> DataFrame:
        return self.written("owned", dims.owned_pairs(self.grain, self.contracts))

    @cached_property
    def devices(self) -> DataFrame:
        return self.written("devices", dims.new_devices(self.owned))

    @cached_property
    def pairs(self) -> DataFrame:
        return dims.pair_keys(self.owned, self.devices)

    @cached_property
    def facts(self) -> DataFrame:
        return wh.fact_viewing_session(self.grain, self.small, self.pairs)

    @cached_property
    def summary(self) -> DataFrame:
        return wh.fact_contract_summary(self.facts, self.small)

    @cached_property
    def stored_facts(self) -> DataFrame:
        """The facts written once, for checks that read them several times."""
        return self.written("facts", self.facts)

    @cached_property
    def stored_summary(self) -> DataFrame:
        return self.written("summary", wh.fact_contract_summary(self.stored_facts, self.small))

    @cached_property
    def keyed_analytics(self) -> DataFrame:
        days = mart.contract_summary_days(self.summary, self.small.date, self.contracts)
        return mart.contract_analytics(mart.with_first_day(days, "ContractKey"))

    @cached_property
    def keyed_daily(self) -> DataFrame:
        return mart.daily_summary(mart.with_calendar(self.summary, self.small.date))

    @cached_property
    def keyed_trend(self) -> DataFrame:
        return mart.content_type_trend(mart.trend_rows(self.facts, self.small))

    # The published marts, which the reports read: loaded once per session and data folder

    @cached_property
    def marts(self) -> VersionedStore:
        key = self.spark.sparkContext.applicationId, self.sf_dir
        if key not in _published:
            root = scratch_path(self.spark, "published")
            stores = pipeline.stores(self.spark, root)
            wh.load_warehouse(self.spark, self.staging, stores[0])
            mart.load_mart(self.spark, *stores)
            _published[key] = root
        return pipeline.stores(self.spark, _published[key])[1]

    @cached_property
    def rolled_up(self) -> str:
        """A root whose rollups have taken in two of three loads: the days of a range are loaded in part, then whole."""
        key = self.spark.sparkContext.applicationId, f"{self.sf_dir}#rollups"
        if key not in _published:
            root = scratch_path(self.spark, "rolled-up")
            warehouse, marts = pipeline.stores(self.spark, root)
            later = [day for day in self.days if RANGE[0] <= day.isoformat() <= RANGE[1]]
            partly = self.staging.where(~F.col("EventDate").between(*[F.lit(day).cast("date") for day in RANGE]) | F.expr(SHORT))
            wh.load_warehouse(self.spark, partly, warehouse)
            for days in (later[0::2], later[1::2]):
                mart.catch_up(self.spark, warehouse, marts)
                rollups.refresh(self.spark, warehouse, marts, pipeline.rolled_up(self.spark, root))
                wh.load_warehouse(self.spark, self.staging, warehouse, process_dates=days)
            mart.catch_up(self.spark, warehouse, marts)
            _published[key] = root
        return _published[key]

    @cached_property
    def analytics(self) -> DataFrame:
        return self.marts.read(mart.ANALYTICS)

    @cached_property
    def daily(self) -> DataFrame:
        return self.marts.read(mart.DAILY)

    @cached_property
    def trend(self) -> DataFrame:
        return self.marts.read(mart.TREND)

    # The same marts straight from the logs, without stored tables

    @cached_property
    def daily_from_logs(self) -> DataFrame:
        return mart.daily_summary(mart.days_from_logs(self.staging))

    @cached_property
    def trend_from_logs(self) -> DataFrame:
        return mart.content_type_trend(mart.trend_from_logs(self.staging), "Contract")

    # Increments: dimensions loaded from the first dates, then extended by the rest

    def _loaded_before(self) -> Column:
        return F.col("EventDate") < F.lit(LOADED_BEFORE).cast("date")

    @cached_property
    def early(self) -> DataFrame:
        return self.grain.where(self._loaded_before())

    @cached_property
    def late(self) -> DataFrame:
        return self.grain.where(~self._loaded_before())

    @cached_property
    def early_contracts(self) -> DataFrame:
        return self.written("early-contracts", dims.new_contracts(self.early))

    @cached_property
    def early_devices(self) -> DataFrame:
        owned = dims.owned_pairs(self.early, self.early_contracts)
        return self.written("early-devices", dims.new_devices(owned))

    @cached_property
    def grown_contracts(self) -> DataFrame:
        return dims.grown(self.early_contracts, dims.new_contracts(self.late, self.early_contracts))

    @cached_property
    def grown_devices(self) -> DataFrame:
        owned = dims.owned_pairs(self.late, self.grown_contracts)
        return dims.grown(self.early_devices, dims.new_devices(owned, self.early_devices))

    # Written forms

    @cached_property
    def landing(self) -> str:
        """Folder of landing JSON written from the events, one sub-folder per day."""
        return adapter.write_landing(self.staging, scratch_path(self.spark, "landing"))

    @cached_property
    def landing_paths(self) -> list[str]:
        """The daily sub-folders: one path per calendar day that has events."""
        days = self.staging.select(F.date_format("EventDate", "yyyyMMdd").alias("day")).distinct().orderBy("day")
        return [f"{self.landing}/day={row.day}" for row in days.collect()]

    @cached_property
    def undated_landing(self) -> list[str]:
        """Daily sub-folders of landing JSON whose records have no date of their own."""
        folder = adapter.write_landing(self.staging, scratch_path(self.spark, "undated"), dated=False)
        return [path.replace(self.landing, folder) for path in self.landing_paths]

    def stage(self) -> DataFrame:
        """Staging written and read back."""
        root = scratch_path(self.spark, "staging")
        files.append_staging(self.staging, root, "all")
        return files.read_staging(self.spark, root)

    def loaded(self) -> tuple:
        """Warehouse and mart stores after a full load of staging."""
        stores = pipeline.stores(self.spark, scratch_path(self.spark, "load"))
        wh.load_warehouse(self.spark, self.staging, stores[0])
        mart.load_mart(self.spark, *stores)
        return stores

