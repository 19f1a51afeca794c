"""Language identification by prediction by partial matching (PPM).

For every language the bytes of a sample fill a context tree: how often each byte followed each
context of up to three bytes. A byte is coded in the longest context that has been seen; a byte new
to a context costs an escape and is coded one order lower, at last among all 256 bytes alike. With
n occurrences and d different bytes in a context, a byte seen c times has probability c / (n + d)
and the escape d / (n + d). The statistics are frozen after learning, so the code length of a text
is a sum over its positions, and the language of the shortest code wins.

As the trees are frozen, each (context, byte) has a fixed cost in each language. Scoring looks up the
longest stored string that ends at a position once and reads the costs in all languages from its row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.llm.tables import is_held_out, text_of

ORDER = 3  # bytes of the longest context
START = b"\n" * ORDER
SAMPLE_DOCS = 300  # documents learned from per language, in expectation
SAMPLE_CHARS = 20_000  # a document of n times as many is chosen n times less often, but taken whole
MAX_LANGUAGES = 200  # with more, each gets a smaller share of the sample
FIT_SHARE, FIT_MARGIN = 0.98, 1.5  # of unseen documents of a language, and how far above them is still its own
FIT_BITS = 64.0  # that a text may cost besides, which decides for very short ones only
BLOCK = 1 << 18  # bytes scored at once
NO_LANGUAGE = "und"
LETTER = regex.compile(r"\p{L}")
PREDICTION = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("bits_per_byte", T.DoubleType()),
    T.StructField("fits", T.BooleanType()),
])


def _folded(text: str) -> np.ndarray:
    """The bytes of a text, A-Z as a-z, after a start that gives its first byte a full context."""
    return np.frombuffer(START + text.encode("utf-8", "replace").lower(), dtype=np.uint8)


def _grams(data: np.ndarray, length: int) -> np.ndarray:
    """Every run of ``length`` bytes as one number."""
    count = max(0, len(data) - length + 1)
    out = np.zeros(count, dtype=np.uint32)
    for offset in range(length):
        out = (out << np.uint32(8)) | data[offset:offset + count]
    return out


class Index:
    """Row numbers of sorted 32-bit keys, in a hash table with few probes."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys = np.zeros(1 << self.bits, dtype=np.uint32)
        self.rows = np.full(1 << self.bits, -1, dtype=np.int32)
        self.probes = 0
        todo = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(todo):  # one linear probe for all keys that are not placed yet
            self.probes += 1
            free = self.rows[slot] < 0
            self.rows[slot[free]] = todo[free]  # of several keys for a slot the last one gets it
            placed = self.rows[slot] == todo
            self.keys[slot[placed]] = keys[todo[placed]]
            todo, slot = todo[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        slot = self._slot(keys)
        found = np.where(self.keys[slot] == keys, self.rows[slot], -1)
        # An empty slot ends a search; rows tells it from a slot that holds key 0.
        todo = np.flatnonzero((found < 0) & (self.rows[slot] >= 0))
        slot = slot[todo]
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            slot = (slot + 1) & ((1 << self.bits) - 1)
            held = self.rows[slot]
            hit = (self.keys[slot] == keys[todo]) & (held >= 0)
            found[todo[hit]] = held[hit]
            going = ~hit & (held >= 0)
            todo, slot = todo[going], slot[going]
        return found


@dataclass
class Model:
    """Frozen trees of all languages: costs in bits, a row per string and a column per language."""

    languages: list[str]
    keys: list[np.ndarray]  # by order: the strings of order + 1 bytes, sorted
    costs: list[np.ndarray]  # by order: bits for the last byte of such a string in the context before it
    escapes: list[np.ndarray]  # by order: bits for leaving that string as a context
    roots: np.ndarray  # bits for a byte that a language has never shown, before the 8 that name it
    limits: np.ndarray  # bits per byte beyond which a text is not in the language
    index: list[Index] | None = None

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of the whole text in every language."""
        if self.index is None:
            self.index = [Index(keys) for keys in self.keys]
        data = _folded(text)
        total = np.zeros(len(self.languages))
        for start in range(0, len(data) - ORDER, BLOCK):  # each block begins with the context of its first byte
            total += self._bits(_grams(data[start:start + BLOCK + ORDER], ORDER + 1))
        return total

    def _bits(self, strings: np.ndarray) -> np.ndarray:
        """Bits of the last byte of every string in the context of the bytes before it."""
        total = np.zeros(len(self.languages))
        for order in range(ORDER, -1, -1):
            rows = self.index[order].find(strings)
            known = rows >= 0
            total += self.costs[order][rows[known]].sum(axis=0)
            strings = strings[~known]
            if not len(strings):
                return total
            if order:
                contexts = self.index[order - 1].find(strings >> np.uint32(8))
                total += self.escapes[order - 1][contexts[contexts >= 0]].sum(axis=0)
                strings = strings & np.uint32((1 << 8 * order) - 1)
        return total + (self.roots + 8.0) * len(strings)


def _size(text: str) -> int:
    return len(text.encode("utf-8", "replace"))


def _limit(texts: list[str]) -> float:
    """The bits per byte that texts in the language of these need at most: infinite for a single text.

    Trees of every other text measure the rest, which they have not seen.
    """
    unseen = [text for text in texts[1::2] if text]
    if not unseen:
        return float("inf")
    half = _trees({"": texts[::2]})
    needs = [float(half.code_lengths(text)[0]) / _size(text) for text in unseen]
    return FIT_MARGIN * float(np.quantile(needs, FIT_SHARE, method="higher"))


def fit(samples: dict[str, list[str]]) -> Model:
    """The trees of texts by language, and what texts of each language need."""
    model = _trees(samples)
    model.limits = np.array([_limit(samples[language]) for language in model.languages])
    return model


def _trees(samples: dict[str, list[str]]) -> Model:
    languages = sorted(samples)
    counts: list[list[tuple[np.ndarray, np.ndarray]]] = []  # by language and order
    for language in languages:
        texts = [_folded(text) for text in samples[language]]
        by_order = []
        for length in range(1, ORDER + 2):
            grams = np.concatenate([_grams(text, length) for text in texts] or [np.zeros(0, np.uint32)])
            by_order.append(np.unique(grams, return_counts=True))
        counts.append(by_order)
    keys = [
        np.unique(np.concatenate([own[level][0] for own in counts])) if counts else np.zeros(0, np.uint32)
        for level in range(ORDER + 1)
    ]
    costs = [np.zeros((len(level), len(languages))) for level in keys]
    escapes = [np.zeros((len(level), len(languages))) for level in keys]
    roots = np.zeros(len(languages))
    for column, own in enumerate(counts):
        for level in range(ORDER + 1):
            strings, seen = own[level]
            # What followed each context: occurrences and different bytes.
            context, at = np.unique(strings >> np.uint32(8), return_inverse=True)
            follow, kinds = np.bincount(at, weights=seen), np.bincount(at)
            leave = np.log2((follow + kinds) / np.maximum(kinds, 1))
            if level == 0:
                roots[column] = leave[0] if len(leave) else 0.0
                lower = np.full(len(keys[0]), 8.0) + roots[column]
            else:
                place = np.searchsorted(keys[level - 1], context)
                escapes[level - 1][place, column] = leave
                # A string unseen here costs the escape of its context, if that was seen, and its tail.
                up = np.searchsorted(keys[level - 1], keys[level] >> np.uint32(8))
                tail = np.searchsorted(keys[level - 1], keys[level] & np.uint32((1 << 8 * level) - 1))
                lower = escapes[level - 1][up, column] + costs[level - 1][tail, column]
            costs[level][:, column] = lower
            costs[level][np.searchsorted(keys[level], strings), column] = np.log2((follow + kinds)[at] / seen)
    return Model(languages, keys, costs, escapes, roots, np.full(len(languages), np.inf))


def sample_texts(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """About ``per_language`` texts of each language, chosen by a hash of the id, one at least.

    Only documents that are not held out, with a language and a text, are looked at, and a chosen text
    is taken whole. Texts of all lengths take part; one of more than ``SAMPLE_CHARS`` characters is
    chosen less often by as much as it is longer. So a language gives about ``per_language`` times
    ``SAMPLE_CHARS`` characters at most, and less where there are more than ``MAX_LANGUAGES``, whatever the
    size of the corpus. The share taken of a language follows from its count.
    """
    text, scale = text_of(docs), 1 << 30
    place = F.pmod(F.xxhash64(docs["doc_id"], F.lit("sample")), F.lit(scale))
    longer = F.greatest(F.length(text) / SAMPLE_CHARS, F.lit(1.0))
    rows = docs.select(docs["lang"].alias("lang"), text.alias("text"), (place * longer).alias("place")).where(
        ~is_held_out(docs["doc_id"]) & docs["lang"].isNotNull() & (F.length(text) > 0))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("first")).orderBy("lang").collect()
    if not sizes:
        return {}
    wanted = per_language * min(1.0, MAX_LANGUAGES / len(sizes))
    limit = F.create_map(*[
        F.lit(value) for row in sizes for value in (row["lang"], max(row["first"], scale * wanted / row["n"]))])
    taken = rows.where(F.col("place") <= limit[F.col("lang")]).select("lang", "text")
    out: dict[str, list[str]] = {row["lang"]: [] for row in sizes}
    for row in taken.collect():
        out[row["lang"]].append(row["text"])
    return {language: sorted(texts) for language, texts in out.items() if texts}


def predictor(spark, model: Model):
    """A column function: the text's language, score and bits per byte, and whether it is that language.

    ``fits`` compares with what the language's own documents need, so it neither depends on how alike
    the learned languages are nor on which of them is the least bad.
    """
    held = spark.sparkContext.broadcast(model)

    def one(text: str) -> tuple[str, float, float, bool]:
        known = held.value
        if not known.languages or not LETTER.search(text):
            return NO_LANGUAGE, 0.0, 0.0, False
        bits = known.code_lengths(text)
        size = _size(text)
        best = int(np.argmin(bits))  # the first by name on a tie
        # The share of the winner when each language weighs 2 to the minus bits of eight average bytes.
        weights = np.exp2(-8.0 * (bits - bits[best]) / size)
        fits = bool(bits[best] <= known.limits[best] * size + FIT_BITS)
        return known.languages[best], float(1.0 / weights.sum()), float(bits[best] / size), fits

    @F.pandas_udf(PREDICTION)
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(text) for text in texts], columns=PREDICTION.names)

    return predict


def learn(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> Model:
    """The model of a table of documents."""
    return fit(sample_texts(docs, per_language))


def predictions(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, bits_per_byte.

    Every text is scored from its first to its last byte. The prediction is ``und`` with score 0 for
    a NULL text, a text without a letter, and wherever no language could be learned. Languages whose
    codes are equally long are decided by name. Rows are scored independently, so repeated rows get
    equal answers; a NULL id counts as held out. Other columns are ignored.
    """
    predict = predictor(docs.sparkSession, learn(docs, per_language))
    return docs.select(
        docs["doc_id"], is_held_out(docs["doc_id"]).alias("held_out"), predict(text_of(docs)).alias("_says"),
    ).select("doc_id", "held_out", "_says.lang_pred", "_says.score", "_says.bits_per_byte")

