"""The registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from viewlog.llm import (
    byte_bpe,
    centroids,
    fm_quality,
    html_mincut,
    kneser_ney,
    language_id,
    license_rules,
    near_dup,
    packing,
    quality_rules,
    sharding,
    vector_dup,
    whitening,
)
from viewlog.llm.tables import importable

_REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(build):
    _REGISTERED[build.__name__] = importable(build)
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTERED)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(_table(spark, sf_dir, "documents"))


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract_pages(_table(spark, sf_dir, "pages"))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.license_scan(_table(spark, sf_dir, "documents"))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN)


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(_table(spark, sf_dir, "documents"))


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def _rounds_sql(rounds: int = centroids.ROUNDS) -> str:
    """Lloyd's rounds as one common table expression after another."""
    size, scale, clusters = centroids.SIZE, centroids.SCALE, centroids.CLUSTERS
    steps = [f"""whole AS MATERIALIZED (
  SELECT vec_id, [CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x FROM embeddings
  WHERE len(embedding) = {size} AND len([c FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = {size})""",
             f"""centre0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) - 1 AS INTEGER) AS cluster, x
  FROM whole ORDER BY sha256('{centroids.SEED}:' || vec_id) LIMIT {clusters})"""]
    for n in range(rounds + 1):
        steps.append(f"""assigned{n} AS MATERIALIZED (
  SELECT vec_id, any_value(x) AS x, min(struct_pack(distance := d, cluster := cluster)) AS best FROM (
    SELECT w.vec_id, w.x, c.cluster, CAST(list_sum([(w.x[i] - c.x[i]) * (w.x[i] - c.x[i]) FOR i IN range(1, {size + 1})]) AS BIGINT) AS d
    FROM whole w, centre{n} c) GROUP BY vec_id)""")
        if n < rounds:
            steps.append(f"""centre{n + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM centre{n} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
      SELECT best.cluster AS cluster, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
      FROM assigned{n}, range(1, {size + 1}) AS r(i) GROUP BY ALL) GROUP BY cluster) m ON m.cluster = c.cluster)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, a.best.cluster AS cluster, a.best.distance AS distance,
  CAST(sum(a.best.distance) OVER (PARTITION BY a.best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM assigned{rounds} a JOIN centre{rounds} c ON c.cluster = a.best.cluster"""


_SQL["op11_centroid_clustering"] = _rounds_sql()


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@query
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.scores(_table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
