"""A quality classifier: a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector x: its words hashed into buckets with weights of unit length, and one
indicator per structure statistic and metadata figure for the band its value falls into. The score is

    sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

and the pairs cost linear time, as their sum is half of |sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.llm.tables import is_held_out, text_of

WORD_BUCKETS = 1 << 13
BANDS = 24  # bands of one statistic
FACTORS = 8
SAMPLE_DOCS = 6_000  # labelled documents learned from, at most
SAMPLE_CHARS = 100_000  # longer documents are not learned from, which bounds the sample in bytes
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 64, 0.05, 1e-5, 7

# Structure statistics and metadata figures: shares in [0, 1] except where a scale is named.
STATISTICS = (
    "chars", "words", "lines", "word_length", "symbols", "upper", "digits", "marks", "pipes", "bangs",
    "repeated_words", "repeated_lines", "short_lines", "unended_lines", "white", "longest_word",
)
FEATURES = WORD_BUCKETS + BANDS * len(STATISTICS)
SCORED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


@lru_cache(maxsize=200_000)
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % WORD_BUCKETS


def statistics(text: str, words: list[str], counts: Counter) -> np.ndarray:
    """The figures named in ``STATISTICS``, all scaled to [0, 1]."""
    size, number = max(1, len(text)), max(1, len(words))
    packed = "".join(words)
    letters = max(1, len(packed))
    lines = [line for line in text.split("\n") if line.strip()]
    n_lines = max(1, len(lines))
    ascii_only = text.encode("ascii", "ignore")
    upper = len(ascii_only) - len(ascii_only.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(ascii_only) - len(ascii_only.translate(None, b"0123456789"))
    marks = len(ascii_only) - len(ascii_only.translate(None, b".,;:"))
    symbols = len(ascii_only) - len(ascii_only.translate(None, b"#*$%&|<>"))
    return np.clip(np.array([
        np.log1p(len(text)) / 14, np.log1p(len(words)) / 12, np.log1p(len(lines)) / 10, len(packed) / number / 24,
        symbols / letters, upper / letters, digits / letters, marks / number, text.count("|") / number,
        text.count("!") / number, 1 - len(counts) / number, 1 - len(set(lines)) / n_lines,
        sum(len(line) < 40 for line in lines) / n_lines,
        sum(line.rstrip()[-1:] not in ".!?" for line in lines) / n_lines,
        1 - len(packed) / size, np.log1p(max(map(len, counts), default=0)) / 8,
    ]), 0.0, 1.0)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of a text's non-zero features; an empty text has its bands only.

    Shares are banded on their square root, since most of them are small.
    """
    words = text.split()
    counts = Counter(words)
    buckets: Counter = Counter()
    for word, count in counts.items():
        buckets[_bucket(word)] += count
    places = np.fromiter(buckets, np.int64, len(buckets))
    weights = np.log1p(np.fromiter(buckets.values(), np.float64, len(buckets)))
    norm = np.sqrt((weights ** 2).sum()) or 1.0
    bands = np.minimum((np.sqrt(statistics(text, words, counts)) * BANDS).astype(np.int64), BANDS - 1)
    return (
        np.concatenate([places, WORD_BUCKETS + BANDS * np.arange(len(STATISTICS)) + bands]),
        np.concatenate([weights / norm, np.full(len(STATISTICS), 1 / np.sqrt(len(STATISTICS)))]),
    )


@dataclass
class Machine:
    """Bias, linear weights and factors."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, places: np.ndarray, values: np.ndarray) -> float:
        scaled = self.factors[places] * values[:, None]
        pairs = 0.5 * ((scaled.sum(axis=0) ** 2).sum() - (scaled ** 2).sum())
        return float(self.bias + self.linear[places] @ values + pairs)

    def score(self, text: str) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(*features(text)), -35, 35))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = SEED) -> Machine:
    """Adaptive gradient descent on the log loss, both labels weighing the same in sum.

    Without rows of both labels nothing can be told apart, and every score is the share of label 1.
    """
    chance = np.random.default_rng(seed)
    linear, factors = np.zeros(FEATURES), chance.normal(0, 0.05, (FEATURES, FACTORS))
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1:
        return Machine(35.0 * (2 * share - 1), linear, np.zeros_like(factors))
    bias, bias_sum = 0.0, 1e-8
    linear_sum, factor_sum = np.full(FEATURES, 1e-8), np.full((FEATURES, FACTORS), 1e-8)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(EPOCHS):
        order = chance.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            chosen = order[start:start + BATCH]
            places = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            scaled = factors[places] * values[:, None]
            sums = np.zeros((len(chosen), FACTORS))
            np.add.at(sums, owner, scaled)
            raw = (
                bias + np.bincount(owner, linear[places] * values, len(chosen))
                + 0.5 * ((sums ** 2).sum(axis=1) - np.bincount(owner, (scaled ** 2).sum(axis=1), len(chosen))))
            slope = weight[chosen] * (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - labels[chosen]) / len(chosen)
            bias_sum += slope.sum() ** 2
            bias -= RATE * slope.sum() / np.sqrt(bias_sum)
            used, at = np.unique(places, return_inverse=True)
            step = slope[owner] * values
            down = np.bincount(at, step, len(used)) + DECAY * linear[used]
            linear_sum[used] += down ** 2
            linear[used] -= RATE * down / np.sqrt(linear_sum[used])
            each = step[:, None] * (sums[owner] - scaled)
            pull = np.stack([np.bincount(at, each[:, k], len(used)) for k in range(FACTORS)], axis=1)
            pull += DECAY * factors[used]
            factor_sum[used] += pull ** 2
            factors[used] -= RATE * pull / np.sqrt(factor_sum[used])
    return Machine(float(bias), linear, factors)


def sample_labelled(docs: DataFrame, labels: DataFrame, size: int = SAMPLE_DOCS) -> DataFrame:
    """At most ``size`` labelled documents that are not held out: text and quality.

    Labels of one id are averaged and rounded, a half counting as 1; NULL labels are passed over. The
    ids are those of the smallest hash, so the choice depends on neither order nor partitions. Labels of
    documents that are not there, or too long to be learned from, do not take the place of others.
    """
    texts = docs.select(docs["doc_id"], text_of(docs).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    marked = (
        labels.select(labels["doc_id"], labels["quality"].cast("double").alias("quality"))
        .where(~is_held_out(F.col("doc_id")) & F.col("quality").isNotNull())
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")))
    there = marked.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = there.orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(size)
    # At most ``size`` rows are broadcast, and an id that stands many times is learned from once.
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("text", "quality")).alias("row")).select("doc_id", "row.*")


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE_DOCS) -> Machine:
    """The machine of a bounded sample. Executors turn the texts into features, the driver gets those.

    A document has at most ``FEATURES`` of them, of six bytes each: 0.3 GB for a whole sample of the worst.
    """
    schema = "doc_id bigint, quality int, places binary, weights binary"

    def rows(batches):
        for batch in batches:
            found = [features(text) for text in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "quality": batch["quality"],
                "places": [places.astype(np.int16).tobytes() for places, _ in found],
                "weights": [values.astype(np.float32).tobytes() for _, values in found]})

    sample = sample_labelled(docs, labels, size).mapInPandas(rows, schema).collect()
    sample.sort(key=lambda row: row["doc_id"])
    return fit(
        [(np.frombuffer(row["places"], np.int16).astype(np.int64),
          np.frombuffer(row["weights"], np.float32).astype(np.float64)) for row in sample],
        np.array([row["quality"] for row in sample], np.float64))


def scorer(spark, machine: Machine):
    """A column function: the text's score and the predicted label. The weights have a fixed size."""
    held = spark.sparkContext.broadcast(machine)

    @F.pandas_udf(SCORED)
    def score(texts: pd.Series) -> pd.DataFrame:
        scores = np.array([held.value.score(text) for text in texts], dtype=np.float64)
        return pd.DataFrame({"score": scores, "predicted": (scores >= 0.5).astype(np.int32)})

    return score


def scores(docs: DataFrame, labels: DataFrame, size: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text enters a score: language, source, id and labels do not. A NULL text is scored as
    an empty one. Rows are scored independently, so repeated rows get equal scores; a NULL id counts
    as held out. With no labels, or labels of one kind only, all scores are that kind's share (0.5
    for none). Other columns are ignored.
    """
    score = scorer(docs.sparkSession, learn(docs, labels, size))
    return docs.select(
        docs["doc_id"], is_held_out(docs["doc_id"]).alias("held_out"), score(text_of(docs)).alias("_says"),
    ).select("doc_id", "held_out", "_says.*")
