"""End-to-end jobs: landing files to profile, staging, warehouse, marts and checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession

from viewlog.operators import profile, rows
from viewlog.operators.aggregates import table_counts
from viewlog.plans import mart, quality, rollups, warehouse
from viewlog.plans.journal import Journal
from viewlog.schema import CALENDAR
from viewlog.sinks import files
from viewlog.sinks.versioned import VersionedStore
from viewlog.sources import landing


def profile_files(
    spark: SparkSession, paths: Sequence[str], labels: str = "vi", dated: bool = True, level: str = "file"
) -> DataFrame:
    """Contract profiles straight from landing files.

    With ``dated`` the day comes from the file name and activation is part of the profile.
    """
    raw = landing.read_files(spark, paths)
    if dated:
        raw = landing.with_name_date(raw, level)
    return profile.contract_profile(rows.staging_rows(raw), labels, day="EventDate" if dated else None)


def load_staging(
    spark: SparkSession,
    paths: Sequence[str],
    staging_root: str,
    run_date: date | str | None = None,
    level: str = "file",
    skip_unreadable: bool = False,
) -> dict[str, object]:
    """Landing files into staging; a file that staging holds already is replaced.

    The event date is the record's own, else that of the file name (``level="folder"``: of the folder
    name), else ``run_date``. A missing or broken file raises, or with ``skip_unreadable`` is left out
    whole, unless it is the first. No files, or files without a usable record, raise ``ValueError``.
    Lines without a record are stored in the same pass and read by ``files.read_rejected``.
    Returns the skipped paths and the number of lines, bad lines and bad durations.
    """
    skipped: list[str] = []
    if skip_unreadable and paths:
        paths, skipped = landing.readable(spark, paths)
    lines = landing.read_lines(spark, paths)
    if rows.staging_rows(landing.parse_lines(lines)).isEmpty():
        raise ValueError("nothing to load into staging")
    seen = Observation()
    counted = landing.parse_lines(landing.with_source(lines, level)).observe(seen, *landing.line_counts())
    shaped = rows.staging_rows(counted, run_date, rejected=True)
    files.append_staging(shaped, staging_root, "files", files=lines.inputFiles(), checked=True)
    return seen.get | {"Skipped": skipped}


def run_pipeline(
    spark: SparkSession,
    paths: Sequence[str],
    root: str,
    process_date: date | str | None = None,
    run_date: date | str | None = None,
    level: str = "file",
    skip_unreadable: bool = False,
    calendar: tuple[str, str] = CALENDAR,
) -> dict[str, object]:
    """Staging, warehouse and marts in turn; an error in one step stops the later ones.

    ``landing.paths_in_range`` and ``landing.paths_in_folder`` give the paths of a date range or a
    folder. Returns the counts of every step.
    """
    loaded = load_staging(spark, paths, staging_folder(root), run_date, level, skip_unreadable)
    return loaded | refresh(spark, root, None if process_date is None else [rows.as_date(process_date)], calendar)


def refresh(
    spark: SparkSession, root: str, dates: list[date] | None, calendar: tuple[str, str] = CALENDAR
) -> dict[str, int]:
    """Rebuild warehouse, media report and marts from staging for the given dates, None meaning all.

    Where a contract's first date moved, in either direction, its other dates follow in the marts. The
    journal of the root says which dates were begun: those of a refresh that failed, wherever it did,
    are done by the next one, whatever its own dates are. One refresh of a root at a time.
    """
    log = Journal(spark, root)
    dates = log.begin(dates)
    (store, marts), reports = stores(spark, root), media(spark, root)
    staged = files.read_staging(spark, staging_folder(root))
    counts = warehouse.load_warehouse(spark, staged, store, process_dates=dates, calendar=calendar)
    counts |= mart.load_media_report(spark, staged, reports, process_dates=dates)
    counts |= mart.catch_up(spark, store, marts, calendar)
    log.end(warehouse=store.position(), mart=marts.position(), media=reports.position())
    return counts


def refresh_rollups(spark: SparkSession, root: str, calendar: tuple[str, str] = CALENDAR) -> dict[str, int]:
    """Bring the rollups of a root to what its last whole refresh left; their reports are right without it as well."""
    store, marts, _ = committed(spark, root)
    return rollups.refresh(spark, store, marts, rolled_up(spark, root), calendar)


def run_with_checks(
    spark: SparkSession, staging: DataFrame, store: VersionedStore, process_date: date | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Warehouse load between two checks: the staging profile, and the row counts of four outputs."""
    before = quality.staging_profile(staging)
    warehouse.load_warehouse(spark, staging, store, process_date)
    after = table_counts(
        TotalContracts=store.read(warehouse.CONTRACTS), TotalDevices=store.read(warehouse.DEVICES),
        TotalSessions=store.read(warehouse.FACTS), TotalSummaries=store.read(warehouse.SUMMARY))
    return before, after


def compact(spark: SparkSession, root: str) -> None:
    """Fold the three stores of a root; what ``committed`` gave before stays readable until the next time."""
    for store in (*stores(spark, root), media(spark, root)):
        store.compact(retain=1)


def committed(spark: SparkSession, root: str) -> tuple[VersionedStore, VersionedStore, VersionedStore]:
    """Warehouse, marts and media report as the last whole refresh left them.

    The three fit each other: what a refresh that is running, or has failed, has published in some of
    them is not seen. Without any refresh they are as they are.
    """
    at = Journal(spark, root).committed()
    (store, marts), reports = stores(spark, root), media(spark, root)
    if at is None:
        return store, marts, reports
    return store.snapshot(at["warehouse"]), marts.snapshot(at["mart"]), reports.snapshot(at["media"])


def staging_folder(root: str) -> str:
    return f"{root}/staging_raw"


def media(spark: SparkSession, root: str) -> VersionedStore:
    return mart.media_store(spark, f"{root}/media")


def stores(spark: SparkSession, root: str) -> tuple[VersionedStore, VersionedStore]:
    return (warehouse.warehouse_store(spark, f"{root}/warehouse"), mart.mart_store(spark, f"{root}/mart"))


def rolled_up(spark: SparkSession, root: str) -> VersionedStore:
    return rollups.rollup_store(spark, f"{root}/rollups")
