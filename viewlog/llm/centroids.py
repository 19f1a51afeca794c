"""Clustering around centroids (Lloyd's rounds of k-means) in whole numbers and built-in expressions.

A vector's components become whole numbers, so distances, sums and means are exact: the result does
not depend on how the rows are dealt out, nor on retried tasks. The centroids, a few rows that every
round collects, stand in the plan as a literal. ``zip_with`` and ``aggregate`` compute a vector's
squared distance to each, ``array_min`` of (distance, number) takes the nearest, and one column sum per
component, combined where the rows lie, moves the centroids. No vector is shuffled in any round: each
is one scan of the stored vectors and a shuffle of at most one row per task and centroid.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.llm.tables import stored
from viewlog.llm.whole_vectors import whole_vectors

SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
MOST = 1 << 27  # a component's size: 64 squared differences of such numbers fit a long
LONGEST = (1 << 63) - 1


def _literal(centroids: list[list[int]]) -> Column:
    arrays = ", ".join(f"array({', '.join(f'{value}L' for value in centroid)})" for centroid in centroids)
    return F.expr(f"cast(array({arrays}) as array<array<bigint>>)")


def _squared_distance(vector: Column, centroid: Column) -> Column:
    apart = F.zip_with(vector, centroid, lambda a, b: a - b)
    return F.aggregate(apart, F.lit(0).cast("bigint"), lambda total, d: total + d * d)


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """The smallest (distance, cluster) over all centroids; the smaller number on a tie."""
    return F.array_min(F.transform(_literal(centroids), lambda centroid, number: F.struct(
        _squared_distance(vector, centroid).alias("distance"), number.cast("int").alias("cluster"))))


def _assigned(kept: DataFrame, centroids: list[list[int]]) -> DataFrame:
    return kept.select("vec_id", "x", nearest(F.col("x"), centroids).alias("_best")).select(
        "vec_id", "x", "_best.cluster", "_best.distance")


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors of the ``clusters`` smallest hashes of seed and id.

    Rows that share an id are told apart by their vectors; rows without an id come last.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.withColumn("_key", key).orderBy(F.col("_key").asc_nulls_last(), "x").limit(clusters)
    return [row["x"] for row in first.select("x").collect()]


def moved(kept: DataFrame, centroids: list[list[int]], size: int) -> list[list[int]]:
    """Every centroid's componentwise floor of the mean of its vectors; without vectors it stays."""
    sums = [F.sum(F.col("x")[n]).alias(f"s{n}") for n in range(size)]
    rows = _assigned(kept, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), *sums).collect()
    out = list(centroids)
    for row in rows:  # one per centroid at most
        out[row["cluster"]] = [row[f"s{n}"] // row["rows"] for n in range(size)]
    return out


def cluster(
    vectors: DataFrame, column: str = "embedding", size: int = SIZE, scale: int = SCALE, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, seed: int = SEED,
) -> DataFrame:
    """One row per clustered vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors of exactly ``size`` components, none NULL or not finite, are clustered; others have no
    row. Components are floor(scale * c); beyond 2**27 in size they count as 2**27, so that squared
    distances fit a long. A sum of distances that does not fit one is NULL. Rows that share an id or
    are equal are clustered one by one; equal starting centroids leave all but the first empty. Rows
    without an id start a cluster only where there are not enough others. With fewer vectors than
    clusters each vector starts one. No rows give no rows; other columns are ignored.
    """
    kept = stored(whole_vectors(vectors, column, scale, MOST).where(F.size("x") == size), "whole-vectors")
    centroids = first_centroids(kept, clusters, seed)
    for _ in range(rounds):
        centroids = moved(kept, centroids, size)
    last = stored(_assigned(kept, centroids).drop("x"), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {row["cluster"]: int(row["inertia"]) for row in last.groupBy("cluster").agg(total.alias("inertia")).collect()}

    def fitting(value: int) -> int | None:
        return value if value <= LONGEST else None

    names = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids]
    about = vectors.sparkSession.createDataFrame(
        [(number, fitting(inertia.get(number, 0)), fitting(sum(inertia.values())), name) for number, name in enumerate(names)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return last.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
