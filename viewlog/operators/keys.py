"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3  # hex digits of the hash: 16**3 = 4096 buckets


def assign_keys(
    members: DataFrame, natural: str, key: str, existing: DataFrame | None = None, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Number distinct natural keys 1, 2, 3 ... after the largest key in ``existing``.

    Keys are ordered by the first digits of their MD5 hash, then by the natural key itself. The
    hash splits distinct keys into buckets of like size that are numbered in parallel; the running
    total over the bucket sizes (16**digits rows, whatever the input size) gives each bucket its
    first number. The order depends on the values alone, so a rerun or a retried task gives the same keys.
    """
    # A left join, though every bucket has a start: an inner one adds a filter to this branch only,
    # and the shuffle that finds the members would then no longer be shared with the sizes.
    bucketed = members.withColumn("_bucket", F.substring(F.md5(natural), 1, digits))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    if existing is not None:
        largest = existing.agg(F.lit("").alias("_bucket"), F.coalesce(F.max(key), F.lit(0)).alias("_size"))
        sizes = sizes.unionByName(largest)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural))
    return (
        bucketed.withColumn("_position", position)
        .join(F.broadcast(starts), "_bucket", "left")
        .withColumn(key, (F.col("_start") + F.col("_position")).cast("bigint"))
        .drop("_bucket", "_position", "_start")
    )
