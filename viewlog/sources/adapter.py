"""Viewing-log columns derived from the given tables (rules in FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.schema import KNOWN_APPS


def log_from_events(events: DataFrame) -> DataFrame:
    """Contract, Mac, AppName, TotalDuration and EventDate for every event."""
    event, user = F.col("event_id"), F.col("user_id")
    names = F.array(*[F.lit(app) for app in (*KNOWN_APPS, "OTHER")])
    slot = ((event * 7 + user) % 16).cast("int")
    return events.select(
        F.concat(F.lit("C"), F.lpad(user.cast("string"), 5, "0")).alias("Contract"),
        F.when(event % 97 == 0, None)
        .otherwise(F.concat(F.lit("M"), F.lpad((user * 2 + event % 4).cast("string"), 6, "0")))
        .alias("Mac"),
        F.get(names, slot).alias("AppName"),
        F.when(event % 89 == 0, None).otherwise(F.round(F.col("value") * 60).cast("bigint")).alias("TotalDuration"),
        F.col("ts").cast("date").alias("EventDate"),
    )


# Ship dates run from 1995 to 2001; 27 years later they lie inside the calendar.
SHIFT_DAYS = 9862


def log_from_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """A larger log: each order line is a view by its customer on its supplier's device."""
    names = F.array(*[F.lit(app) for app in (*KNOWN_APPS, "OTHER")])
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("Contract"),
        F.concat(F.lit("M"), F.lpad(F.col("l_suppkey").cast("string"), 7, "0")).alias("Mac"),
        F.get(names, (F.col("l_partkey") % 16).cast("int")).alias("AppName"),
        (F.col("l_quantity") * 60).cast("bigint").alias("TotalDuration"),
        F.date_add(F.col("l_shipdate").cast("date"), SHIFT_DAYS).alias("EventDate"),
    )


def staging_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def write_landing(staging: DataFrame, folder: str, dated: bool = True) -> str:
    """Write staging rows back out as landing JSON, one sub-folder of files per day.

    Records carry their date, unless ``dated`` says that the folder name alone has it.
    """
    day = F.date_format("EventDate", "yyyyMMdd")
    source = F.struct("Contract", "Mac", "AppName", "TotalDuration", *([day.alias("Date")] if dated else []))
    rows = staging.select(source.alias("_source"), day.alias("day"))
    rows.hint("rebalance", F.col("day")).write.partitionBy("day").json(folder)
    return folder
