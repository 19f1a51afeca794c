"""Contiguous shards of near-equal byte size.

Documents are laid end to end in the order of their id. Every range partition sums its sizes, a
running total over the partitions gives each its first byte, and equal targets on that global scale
are the cuts between the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewlog.llm.tables import stored, text_of

ROW_BYTES = 8  # what a document counts for besides its text
RUN = 10_000  # equal rows that are numbered at once


def byte_shards(docs: DataFrame, shards: int = 24, partitions: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, first_byte.

    A document belongs to the shard its middle byte falls into, so a shard misses its target by at
    most half a document at either end. ``slot`` numbers a shard's documents from 0 without gaps.
    ``partitions`` is the number of range partitions, which is also the most rows that the running
    totals ever see.

    A NULL text has no bytes and the checksum of the empty text. Rows that agree in id, size and
    checksum are told apart by nothing but their number: they are counted first and take
    consecutive places. Those of a row repeated any number of times are numbered in runs of ``RUN``,
    and the runs of a row with several are dealt to all tasks. A NULL id sorts first. Other columns are
    ignored; no rows give no rows.
    """
    if shards < 1:
        raise ValueError("there is at least one shard")
    spark = docs.sparkSession
    partitions = partitions or max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = text_of(docs).cast("binary")
    order = ["doc_id", "size", "text_crc32"]
    rows = docs.select(
        docs["doc_id"], (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"))
    distinct = rows.groupBy(*order).agg(F.count("*").alias("copies"))
    laid = stored(
        distinct.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id()), "shard-order")

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy("part").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))
    starts = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_byte"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("part_row"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))

    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starting = (
        laid.withColumn("byte", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(within), F.lit(0)))
        .withColumn("row", F.coalesce(F.sum("copies").over(within), F.lit(0)))
        .join(F.broadcast(starts), "part"))  # a row per range partition
    often = F.col("copies") > RUN
    one_run = starting.where(~often).withColumn("run", F.lit(0).cast("bigint"))
    first_of_run = F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(RUN).cast("bigint"))
    runs = (
        starting.where(often).withColumn("run", F.explode(first_of_run))
        .repartition(partitions, *order, "run"))
    last = F.least(F.col("run") + F.lit(RUN), F.col("copies")) - 1
    placed = (
        one_run.unionByName(runs)
        .withColumn("copy", F.explode(F.sequence(F.col("run"), last)))
        .withColumn("first_byte", F.col("part_byte") + F.col("byte") + F.col("copy") * F.col("size"))
        .withColumn("number", F.col("part_row") + F.col("row") + F.col("copy")))
    cut = F.expr(f"int(least((2 * first_byte + size) * {shards} div (2 * total), {shards} - 1))")
    placed = stored(placed.select(*order, "first_byte", "number", cut.alias("shard")), "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("number").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *order, F.lit("bytes").alias("law"), "shard", (F.col("number") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "first_byte")

