"""Connected components of a list of links, by passing on the smallest label.

Every node starts as its own label. In each round a node takes the smallest label among its
neighbours, and the label of its label, which doubles the distance that labels travel. The smallest
label that a node hears of also goes to the node that was its label, and to the label of that one:
so whole trees move under a smaller label at once, whatever the order of ids along a path. A round is
one job of joins and grouped minima over links; no neighbourhood is ever gathered, so a node with
very many links is a skewed join at worst, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from viewlog.llm.tables import stored


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """The smallest reachable node of every linked node: columns node, component.

    ``links`` holds pairs of whole numbers; loops, NULLs, repeated and reversed pairs do no harm.
    Nodes without a link to another are not returned. No links give no rows. Labels only ever fall, so
    the rounds end by themselves; restated in numpy, paths of up to 100,000 shuffled ids took at most 15.
    """
    proper = links.where(F.col(left) != F.col(right)).select(  # neither loops nor NULLs
        F.col(left).alias("source"), F.col(right).alias("node"))
    both = proper.unionByName(proper.select(F.col("node").alias("source"), F.col("source").alias("node")))
    both = stored(both.distinct(), "links")
    first = both.groupBy("node").agg(F.least("node", F.min("source")).alias("component"))
    labels, before = _counted(first, "component")
    while True:
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = labels.join(up, "component").select("node", F.col("up").alias("low"), F.col("component").alias("old"), "up")
        heard = both.join(jumped.select(F.col("node").alias("source"), "low"), "source").select("node", "low")
        lowest = heard.unionByName(jumped, allowMissingColumns=True).groupBy("node").agg(
            F.min("low").alias("component"), F.max("old").alias("old"), F.max("up").alias("up"))
        told = lowest.select(F.explode(F.array_distinct(F.array("node", "old", "up"))).alias("node"), "component")
        labels, now = _counted(told.groupBy("node").agg(F.min("component").alias("component")), "component")
        if now == before:
            return labels
        before = now


def _counted(labels: DataFrame, name: str) -> tuple[DataFrame, object]:
    """The labels, stored, and a checksum taken while they were written."""
    seen = Observation()
    checksum = F.bit_xor(F.xxhash64("node", "component")).alias("checksum")
    labels = stored(labels.observe(seen, checksum), name)
    return labels, seen.get["checksum"]
