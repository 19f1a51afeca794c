"""Joins against dimensions.

Every dimension has one row per key, so a lookup never multiplies rows. The only scale risk is a
key that owns a large share of the rows; ``lookup`` spreads such keys over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.operators.rows import nothing

TARGET_ROWS = 1_000_000  # rows of one key that a task takes without being split
MAX_HEAVY = 10_000  # bounds the heavy keys, and so what is broadcast, by raising the target


def heavy_keys(
    rows: DataFrame, key: str, target: int = TARGET_ROWS, limit: int = MAX_HEAVY
) -> DataFrame:
    """Values of ``key`` with more than ``target`` rows, and the tasks each is to be spread over.

    Keys above a target are at most all rows / target; where that could exceed ``limit``, the target is
    raised to all rows / limit. So any key that would burden a task is among them, however many there
    are, and its slots hold the target on average. Rows that are no more than a target hold no such key.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    total = rows.count()
    target = max(target, -(-total // limit))
    heavy = counts.where(F.col("_rows") > target).select(
        key, F.ceil(F.col("_rows") / target).cast("int").alias("_slots"))
    # At most ``limit`` rows; as literal rows they are counted once, however often a plan uses them.
    found = heavy.collect() if total > target else []
    return rows.sparkSession.createDataFrame(found, heavy.schema) if found else nothing(rows.sparkSession, heavy.schema)


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    dimension_key: str,
    heavy: DataFrame,
    spread: list[str],
    how: str = "inner",
) -> DataFrame:
    """Join ``rows`` to a large dimension, splitting the heavy keys.

    Rows of a heavy key get a slot from the hash of the ``spread`` columns, and only the heavy
    dimension rows are repeated once per slot. The slot depends on the row alone, so a retried task
    lands its rows where the first attempt did. In a left join, rows without a key are spread too.
    ``heavy`` is broadcast: ``heavy_keys`` bounds it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup joins are inner or left, not {how!r}")
    if how == "inner":
        rows = rows.where(F.col(key).isNotNull())
    # A row without a key matches nothing, so it may take any slot.
    slots = F.coalesce(F.col("_slots"), F.when(F.col(key).isNull(), F.lit(MAX_HEAVY)).otherwise(1))
    slot = F.pmod(F.xxhash64(*spread), slots).cast("int")
    left = rows.join(F.broadcast(heavy), key, "left").withColumn("_slot", slot).drop("_slots")
    right = (
        dimension.withColumnRenamed(dimension_key, key)
        .join(F.broadcast(heavy), key, "left")
        .withColumn("_slot", F.explode(F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1)))
        .drop("_slots")
    )
    return left.join(right, [key, "_slot"], how).drop("_slot")


def not_in(rows: DataFrame, known: DataFrame, key: str, known_key: str) -> DataFrame:
    """Rows whose key the other table does not hold."""
    return rows.join(known.select(F.col(known_key).alias(key)), key, "left_anti")


def only_in(rows: DataFrame, known: DataFrame, key: str, known_key: str) -> DataFrame:
    """Rows whose key the other table holds."""
    return rows.join(known.select(F.col(known_key).alias(key)), key, "left_semi")
