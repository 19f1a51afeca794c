"""Structured Streaming jobs: file ingest, refresh of touched dates, running daily totals.

Each runs through what has arrived and stops (``availableNow``), so a nightly schedule can start it;
the checkpoint folder remembers which files are done. Staging knows which files it holds, so a batch
that is repeated, or files that are read again under a new checkpoint, replace their rows, and several
streams can feed one staging folder.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.functions import measures
from viewlog.operators import rows
from viewlog.plans import pipeline
from viewlog.plans.journal import Journal
from viewlog.schema import CALENDAR
from viewlog.sinks import files
from viewlog.sources import landing


def new_files(spark: SparkSession, folder: str, level: str = "file", per_batch: int | None = None) -> DataFrame:
    """Stream of raw records from landing files, with the path and the date of their name, and of rejected lines."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    lines = reader.text(folder, pathGlobFilter="*.json")
    return landing.parse_lines(landing.with_source(lines, level))


def _run(stream: DataFrame, per_batch, checkpoint: str, mode: str = "append") -> None:
    (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(per_batch)
        .start()
        .awaitTermination()
    )


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    staging_root: str,
    checkpoint: str,
    run_date: date | str | None = None,
    level: str = "file",
    per_batch: int | None = None,
) -> None:
    """Bring the landing files that arrived since the last run into staging, each exactly once.

    Dates are found as in ``pipeline.load_staging``; records without any date are kept with none.
    """

    def append(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            files.append_staging(batch, staging_root, "stream", checked=True)

    stream = rows.staging_rows(new_files(spark, folder, level, per_batch), run_date, rejected=True)
    _run(stream, append, checkpoint)


def ingest_and_refresh(
    spark: SparkSession,
    folder: str,
    root: str,
    checkpoint: str,
    run_date: date | str | None = None,
    level: str = "file",
    per_batch: int | None = None,
    calendar: tuple[str, str] = CALENDAR,
) -> None:
    """Ingest new files and rebuild warehouse and marts for the dates they touch.

    A date is rebuilt from all of its staging rows, so a late file simply touches its date again, and
    a file that is read again touches the dates it had before as well. The dates are put down in the
    journal before staging changes: a batch that fails anywhere and is repeated loses none.
    """

    def append_and_refresh(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        staging = pipeline.staging_folder(root)
        before = files.dates_held(spark, staging, batch)
        # At most one value per calendar day; dates outside the calendar reach no table.
        touched = rows.between(batch, *calendar, "EventDate").select("EventDate").distinct()
        dates = sorted({row.EventDate for row in touched.collect()} | set(before))
        Journal(spark, root).begin(dates)
        files.append_staging(batch, staging, "stream", checked=True)
        pipeline.refresh(spark, root, dates, calendar)

    stream = rows.staging_rows(new_files(spark, folder, level, per_batch), run_date, rejected=True)
    _run(stream, append_and_refresh, checkpoint)


def daily_totals(logs: DataFrame, late: str | None = None, calendar: tuple[str, str] = CALENDAR) -> DataFrame:
    """Running seconds, sessions and estimated contracts per event date and category.

    Days may come in any order. The state is a row per calendar day and category, so it is bounded
    without a watermark; rows outside the calendar, or without a date, are left out. With ``late``,
    event time is the UTC midnight of the event date, rows further behind the newest date are left
    out as well, and finished days leave the state.
    """
    midnight = F.timestamp_seconds(F.unix_date("EventDate") * 86400)
    dated = rows.with_category(rows.between(logs, *calendar, "EventDate")).withColumn("day", midnight)
    return (
        (dated.withWatermark("day", late) if late else dated)
        .groupBy("day", "Type")
        .agg(
            F.sum(measures.or_zero("TotalDuration")).alias("TotalDuration"),
            F.count("*").alias("TotalSessions"),
            F.approx_count_distinct("Contract").alias("ApproxContracts"),
        )
        .select(F.date_from_unix_date((F.unix_seconds("day") / 86400).cast("int")).alias("DateValue"), "Type",
                "TotalDuration", "TotalSessions", "ApproxContracts")
    )


def write_daily_totals(totals: DataFrame, path: str, checkpoint: str) -> None:
    """Store the days each batch changed; a batch has at most one row per day and category."""

    def store(batch: DataFrame, number: int) -> None:
        batch.repartition(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    _run(totals, store, checkpoint, mode="update")


def read_daily_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest totals of every day and category."""
    stored = spark.read.parquet(path)
    measured = ["TotalDuration", "TotalSessions", "ApproxContracts"]
    newest = stored.groupBy("DateValue", "Type").agg(F.max_by(F.struct(*measured), "batch").alias("last"))
    return newest.select("DateValue", "Type", "last.*")
