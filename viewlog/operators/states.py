"""States of which contracts were active, as bitmaps of their keys, that merge exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_state(keyed: DataFrame, *by: str) -> DataFrame:
    """Seconds, sessions and active contracts per group and bucket of contract keys.

    ``keyed`` holds sessions with ``ContractKey``, ``TotalDuration`` and ``SessionCount``. Every task adds up
    its own rows first, and a group passes on at most one bitmap per task and bucket.
    """
    return keyed.groupBy(*by, F.bitmap_bucket_number("ContractKey").alias("Bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("ContractKey")).alias("Contracts"),
        F.sum("TotalDuration").alias("TotalDuration"), F.sum("SessionCount").alias("TotalSessions"))


def merged_state(states: DataFrame, *by: str | Column) -> DataFrame:
    """States of parts, such as files or days, united per group: as if all rows had been read at once."""
    return states.groupBy(*by, "Bucket").agg(
        F.bitmap_or_agg("Contracts").alias("Contracts"),
        F.sum("TotalDuration").alias("TotalDuration"), F.sum("TotalSessions").alias("TotalSessions"))


def counted(states: DataFrame, *by: str) -> DataFrame:
    """Seconds, sessions and the exact number of different contracts per group."""
    return merged_state(states, *by).groupBy(*by).agg(
        F.sum("TotalDuration").alias("TotalDuration"), F.sum("TotalSessions").alias("TotalSessions"),
        F.coalesce(F.sum(F.bitmap_count("Contracts")), F.lit(0)).alias("UniqueContracts"))
