"""An interpolated modified Kneser-Ney model of word n-grams, and the perplexity of texts under it.

Learning is a few jobs. The words of the training documents are counted into a sorted hash array; the
place of a word in it is its number. The n-grams of highest order are counted by these numbers, and
from then on every level comes from the one above it: a level's n-grams, grouped by all words but the
last, give the contexts (their total and how many continuations were seen once, twice, more often), and
grouped by all words but the first give the next level's n-grams with the number of words seen before
them. Tasks add up what they have read before anything is shuffled, and n-grams are dealt out by their
own hash, so a word or context that holds a third of all of them burdens no task.

Every level is stored as two hash tables (``hash_arrays``), of n-grams and of contexts, which scoring
maps into memory. A text's probability is the product over its words and its end of

    p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h) + gamma(h) * p(w | h without its first word)

with discounts D of n-grams seen once, twice and more often, estimated at each level from how many
n-grams were seen one to four times; below the words lies the uniform distribution over the training
vocabulary and one unknown word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.llm import hash_arrays
from viewlog.llm.hash_arrays import HashTable, Reader, hash_numbers
from viewlog.llm.tables import discard, stored, text_of
from viewlog.llm.word_hashes import START, Block, blocks
from viewlog.session import scratch_path

ORDER = 2
HELD_OUT_OF = 10  # documents with crc32(doc_id) mod 10 = 0 are never learned from
SMOOTHING = 0.1  # of the base model: added to every word's count
PER_SHARD = 1 << 20  # words of the training texts per shard
COUNTED = 1 << 20  # words of which counts are added up before they are sent on
MERGED = 1 << 18  # n-grams whose sides are added up before they are sent on
SCORES = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])


@dataclass(frozen=True)
class Level:
    """The n-grams of one length and their contexts; ``contexts`` is None for single words."""

    grams: HashTable
    contexts: HashTable | None
    discounts: tuple[float, float, float]
    total: float = 0.0  # of the one, empty context of single words
    backoff: float = 0.0


@dataclass(frozen=True)
class Model:
    order: int
    words: HashTable
    levels: tuple[Level, ...]  # single words first
    tokens: int
    vocabulary: int

    @property
    def start(self) -> int:
        """The number of what stands before a text."""
        return self.vocabulary

    @property
    def unknown(self) -> int:
        return self.vocabulary + 1


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of the model; a NULL id counts as held out."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % HELD_OUT_OF == 0, F.lit(True))


def _texts(batch: pa.RecordBatch) -> pa.StringArray:
    return batch.column("text")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(map(_texts, batches), 1, COUNTED):
        counts = np.bincount(block.local, minlength=len(block.hashes))
        yield pa.RecordBatch.from_arrays([pa.array(block.hashes), pa.array(counts)], ["word", "count"])


def _numbers(model: Model, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and training counts of the distinct words of a block."""
    place, count = Reader.of(model.words).find(block.hashes, "count")
    before = block.hashes == START
    return np.where(before, model.start, np.where(place < 0, model.unknown, place)), np.where(before, 0, count)


def _count_grams(model: Model) -> Callable:
    """Counts of the n-grams of highest order of every block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(map(_texts, batches), model.order, COUNTED):
            ends = np.flatnonzero(block.row >= 0)
            size, code, bound = len(block.hashes), np.zeros(len(ends), dtype=np.int64), 1
            for back in range(model.order - 1, -1, -1):
                if bound * size >= 1 << 62:
                    code, bound = np.unique(code, return_inverse=True)[1], len(code)
                code, bound = code * size + block.local[ends - back], bound * size
            _, first, counts = np.unique(code, return_index=True, return_counts=True)
            numbers = _numbers(model, block)[0][block.local]
            ids = [pa.array(numbers[ends[first] - back]) for back in range(model.order - 1, -1, -1)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(counts)], [*_ids(model.order), "count"])

    return count


def _ids(length: int) -> list[str]:
    return [f"w{n}" for n in range(length)]


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


def discounts_of(seen: list[int]) -> tuple[float, float, float]:
    """Discounts of n-grams seen once, twice and more often, from how many were seen 1, 2, 3 and 4 times.

    Where these numbers are too few to divide by, 0.5, 1 and 1.5 are taken.
    """
    once, twice, thrice, four = seen
    if not (once and twice and thrice):
        return 0.5, 1.0, 1.5
    share = once / (once + 2 * twice)
    raw = (1 - 2 * share * twice / once, 2 - 3 * share * thrice / twice, 3 - 4 * share * four / thrice)
    return tuple(min(max(value, 0.0), float(number)) for number, value in enumerate(raw, start=1))


PROFILE = ("total", "kinds", "once", "twice")
SUMS = ("once", "twice", "more", "extra")  # what is shuffled for them: nearly always 1, 0, 0, 0, which packs well
KINDS_SEEN, OCCURRENCES = "once + twice + more", "once + twice + more + extra"


def _discounted(found: dict, discounts: tuple[float, float, float]):
    """What the discounts take from all n-grams of a context; over their total, the lower level's weight."""
    return discounts[0] * found["once"] + discounts[1] * found["twice"] + discounts[2] * (
        found["kinds"] - found["once"] - found["twice"])


def _merged(runs: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined to some of at least ``size`` rows."""
    held: list[pa.RecordBatch] = []
    for run in runs:
        held.append(run)
        if sum(map(len, held)) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _sides(length: int) -> Callable:
    """Per context: how many kinds of n-grams were seen once, twice, more often, and their occurrences
    beyond the first; per n-gram without its first word the same, with all kinds in the place of ``once``.

    With single words there is one side, the empty context. Counts of three and four are only used in sum.
    """
    ids = _ids(length)
    taken = [(False, ids[:-1]), (True, ids[1:])] if length > 1 else [(False, [])]

    def sides(runs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _merged(runs, MERGED):
            columns = {name: run.column(name).to_numpy() for name in (*ids, "count")}
            count = columns["count"]
            for suffix, names in taken:
                chosen = [columns[name] for name in names]
                key = hash_numbers(chosen) if chosen else np.zeros(len(count), dtype=np.int64)
                distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
                kinds, none = np.bincount(back), np.zeros(len(distinct))
                once, twice, thrice, four = (
                    (kinds, none, none, none) if suffix else (np.bincount(back, count == n) for n in (1, 2, 3, 4)))
                sums = [once, twice, kinds - once - twice, np.bincount(back, count) - kinds, thrice, four]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(distinct), suffix)), *(pa.array(column[first]) for column in chosen),
                     *(pa.array(total.astype(np.int64)) for total in sums)],
                    ["suffix", *ids[:-1], *SUMS, "thrice", "four"])

    return sides


def _level(spark: SparkSession, folder: str, model: Model, grams: DataFrame, length: int) -> tuple[Level, DataFrame | None, DataFrame]:
    """One level stored, the n-grams of the next lower one with their counts, and the table they are read from."""
    rest = _ids(length)[:-1]
    table = hash_arrays.table(folder, f"grams{length}", model.tokens, PER_SHARD, count="float")
    seen = Observation()
    layout = T.StructType([T.StructField("suffix", T.BooleanType()), *_longs(*rest, *SUMS, "thrice", "four").fields])
    sides = hash_arrays.write(grams, table, _ids(length), _sides(length), layout).observe(
        seen, *[F.sum(F.when(~F.col("suffix"), F.col(name))).alias(name) for name in (*SUMS, "thrice", "four")])
    added = sides.groupBy("suffix", *rest).agg(*[F.sum(name).alias(name) for name in SUMS])
    both = stored(added.select(
        "suffix", *rest, F.expr(OCCURRENCES).alias("total"), F.expr(KINDS_SEEN).alias("kinds"), "once", "twice"), "ngram-sides")
    found = {name: value or 0 for name, value in seen.get.items()}
    found["kinds"] = found["once"] + found["twice"] + found["more"]
    found["total"] = found["kinds"] + found["extra"]
    discounts = discounts_of([found[name] for name in ("once", "twice", "thrice", "four")])
    if length == 1:
        backoff = _discounted(found, discounts) / max(found["total"], 1) if found["total"] else 1.0
        return Level(hash_arrays.published(spark, table), None, discounts, float(found["total"]), backoff), None, both
    contexts = hash_arrays.table(folder, f"contexts{length}", model.tokens, PER_SHARD, total="float", backoff="float")
    profile = {name: F.col(name) for name in PROFILE}
    hash_arrays.store(both.where(~F.col("suffix")).select(
        F.xxhash64(*rest).alias("hash"), "total", (_discounted(profile, discounts) / F.col("total")).alias("backoff")), contexts)
    # What starts a text has no word before it, so there its occurrences count.
    lower = F.when(F.col("w0") == model.start, F.col("total")).otherwise(F.col("kinds"))
    below = both.where("suffix").select(*rest, lower.alias("count"))
    return Level(hash_arrays.published(spark, table), hash_arrays.published(spark, contexts), discounts), below, both


def learn(documents: DataFrame, order: int = ORDER) -> Model:
    """Count the documents and store their model in the shared folder."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "llm/ngrams")
    texts = documents.select(text_of(documents).alias("text"))
    counted = stored(texts.mapInArrow(_count_words, _longs("word", "count")).groupBy("word").agg(
        F.sum("count").alias("count")), "word-counts")
    sums = counted.agg(F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    tokens, vocabulary = sums["tokens"] or 0, sums["words"]
    words = hash_arrays.table(folder, "words", vocabulary, PER_SHARD, count="bigint")
    if not tokens:
        return Model(order, words, (), 0, 0)
    hash_arrays.store(counted.withColumnRenamed("word", "hash"), words)
    discard(counted)
    model = Model(order, hash_arrays.published(spark, words), (), tokens, vocabulary)

    grams = texts.mapInArrow(_count_grams(model), _longs(*_ids(order), "count"))
    levels, done = [], []
    for length in range(order, 0, -1):
        level, grams, both = _level(spark, folder, model, grams, length)
        levels.insert(0, level)
        done.append(both)
    for both in done:  # all tables are complete
        discard(both)
    return Model(order, model.words, tuple(levels), tokens, vocabulary)


def probabilities(model: Model, block: Block, numbers: np.ndarray) -> np.ndarray:
    """The probability of every word of a block after the words before it, in order."""
    ends = np.flatnonzero(block.row >= 0)

    def looked_up(target: HashTable, first: int, last: int, *columns: str) -> list[np.ndarray]:
        """Values of the n-grams from ``first`` to ``last`` words back."""
        if first == last:  # a single word: once per distinct word
            found = Reader.of(target).find(hash_numbers([numbers]), *columns)[1:]
            return [column[block.local[ends - first]].astype(np.float64) for column in found]
        ids = [numbers[block.local[ends - back]] for back in range(first, last - 1, -1)]
        return [column.astype(np.float64) for column in Reader.of(target).find(hash_numbers(ids), *columns)[1:]]

    low = np.full(len(ends), 1.0 / (model.vocabulary + 1))
    for length, level in enumerate(model.levels, start=1):
        count, = looked_up(level.grams, length - 1, 0, "count")
        if level.contexts is None:
            total, weight = np.full(len(ends), level.total), np.full(len(ends), level.backoff)
        else:
            total, weight = looked_up(level.contexts, length - 1, 1, "total", "backoff")
            weight = np.where(total > 0, weight, 1.0)  # after a context never seen, the lower level decides alone
        # What was not seen has the discount of 0 here.
        taken = np.array([0.0, *level.discounts])[np.minimum(count, 3).astype(np.int64)]
        low = np.where(total > 0, (count - taken) / np.maximum(total, 1), 0.0) + weight * low
    return low


def score_texts(model: Model, texts: pa.StringArray) -> dict[str, np.ndarray]:
    """Counts and scores of texts, in the columns of ``SCORES``."""
    out = {"n_tokens": np.zeros(len(texts), np.int64), "n_known": np.zeros(len(texts), np.int64),
           "base_score": np.zeros(len(texts)), "score": np.zeros(len(texts))}
    mass = model.tokens + SMOOTHING * (model.vocabulary + 1)
    for block in blocks([texts], model.order):
        numbers, count = _numbers(model, block)
        own = block.row >= 0
        row, local = block.row[own], block.local[own]
        base = np.log10((count + SMOOTHING) / mass)
        logs = np.log10(probabilities(model, block, numbers))
        for name, values in (("n_tokens", None), ("n_known", count[local] > 0), ("base_score", base[local]), ("score", logs)):
            out[name] += np.bincount(row, values, len(texts)).astype(out[name].dtype)
    return out


def scores(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    ``n_tokens`` counts the words and the end, ``n_known`` those of them that were seen in training;
    ``base_score`` is the logarithm to base 10 of the text's probability when words are drawn one by one,
    ``score`` under the model, and ``perplexity`` the model's, per token. Only documents that are not
    held out are learned from; one without an id is held out. A NULL text is empty and consists of its
    end. Words are told apart by 64-bit hashes: with V words two share one with probability V**2 / 2**65.
    Rows that share an id, or are equal, are learned from and scored one by one. Without training
    documents every token has the probability 1 in both. No rows give no rows; other columns are ignored.
    """
    rows = documents.select(documents["doc_id"], text_of(documents).alias("text"), held_out(documents["doc_id"]).alias("held_out"))
    model = learn(rows.where(~F.col("held_out")).select("text"), order)
    schema = T.StructType([rows.schema["doc_id"], rows.schema["held_out"], *SCORES.fields])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = score_texts(model, _texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *map(pa.array, columns.values())], schema.fieldNames())

    return rows.mapInArrow(scored, schema).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
