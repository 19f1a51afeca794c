"""The corpus pipeline: which documents stay, and how they are packed.

Each stage reads what its predecessor kept, as Parquet, and all but the last return documents with
the columns they came with, whatever these are. Rows are handled one by one up to the deduplication,
so repeated rows, NULLs, empty and very long texts are decided like any other row; empty tables pass
through. An extra column of any name but the four that are read (doc_id, text, lang, source) is only carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.llm import fm_quality, language_id, near_dup, packing
from viewlog.llm.tables import importable, stored, text_of


def _carried(docs: DataFrame, says, verdict) -> DataFrame:
    """The rows for which ``verdict`` of what ``says`` computes from the text is true."""
    name = "_says"
    while name in {column.lower() for column in docs.columns}:
        name += "_"
    return docs.withColumn(name, says(text_of(docs))).where(verdict(F.col(name))).drop(name)


@importable
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine predicts to be of good quality.

    It learns from the table of labels in ``sf_dir``.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = fm_quality.scorer(spark, fm_quality.learn(docs, labels))
    return _carried(docs, score, lambda says: says["predicted"] == 1)


@importable
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus: a text without a letter, or one that needs
    more bits than the documents of its nearest language do, goes. All stay where no language could
    be learned."""
    model = language_id.learn(docs)
    if not model.languages:
        return docs
    predict = language_id.predictor(spark, model)
    return _carried(docs, predict, lambda says: (says["lang_pred"] != language_id.NO_LANGUAGE) & says["fits"])


@importable
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    return near_dup.without_near_duplicates(docs)


@importable
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the words of every document go: pieces, bins and offsets."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality), ("language_id", language), ("minhash_near_dedup", near_dedup),
          ("best_fit_packing", pack)]

# Learned models and graph components are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return docs
