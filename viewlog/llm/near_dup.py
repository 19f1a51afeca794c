"""Near-duplicate documents by min-max hashing of word shingles.

Each of 64 permutations of the shingles of a document gives two signature values, its minimum and its
maximum, so 128 values cost 64 hash evaluations per shingle. Both agree between two documents with the
probability of their Jaccard similarity. Bands of four values are looked up as keys; documents that
share a key are candidates, and a link is confirmed on the full sets of shingles.

Equal word sequences are merged first and stand for one node. Within a bucket of candidates, links are
first sought to one centre. What remains are buckets that hold several components. Their documents
are searched exactly: two sets that are similar enough share one of their rarest shingles, at places
that leave room for the rest. So no link that would join two components is missed, while a family of
thousands that are not quite similar enough is told apart without a comparison of all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.llm.components import components
from viewlog.llm.tables import stored, text_of

SHINGLE = 5
PERCENT = 75  # of the union that the intersection has to reach
PERMUTATIONS = 64
BAND = 4  # values per band: 32 bands; at 0.75 a pair shares none with probability 5e-6
SEED = 20240229
ROWS = 2048  # shingles hashed at once
SIZE_STEP = 1.1  # ratio of neighbouring size classes

_CONSTANTS = np.random.default_rng(SEED)
MULTIPLIERS = _CONSTANTS.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MASKS = _CONSTANTS.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
PLACES = _CONSTANTS.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IN_BAND = _CONSTANTS.integers(0, 2**63, BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BANDS = 2 * PERMUTATIONS // BAND
BAND_SALT = _CONSTANTS.integers(0, 2**63, BANDS, dtype=np.uint64)

SIGNATURE = T.StructType([
    T.StructField("n_shingles", T.LongType()),
    T.StructField("digest", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])


def words_of(text: str) -> list[bytes]:
    """Words of a text, A-Z as a-z. ``bytes`` splits at and lowers ASCII characters only."""
    return text.encode("utf-8", "replace").lower().split()


def shingles_of(text: str) -> set[bytes]:
    """The set that similarity is defined on: five words each, or all words where they are fewer."""
    words = words_of(text)
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[at:at + SHINGLE]) for at in range(len(words) - SHINGLE + 1)}


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def _shingle_hashes(words: list[bytes]) -> np.ndarray:
    """The different shingles as 64-bit numbers."""
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=SEED)], dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    count = len(words) - SHINGLE + 1
    total = np.zeros(count, dtype=np.uint64)
    for place in range(SHINGLE):
        total += hashed[place:place + count] * PLACES[place]
    return np.unique(_mixed(total))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of a set's bands: half of them from the minima, half from the maxima."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for start in range(0, len(shingles), ROWS):
        permuted = (shingles[start:start + ROWS, None] ^ MASKS) * MULTIPLIERS
        np.minimum(low, permuted.min(axis=0), out=low)
        np.maximum(high, permuted.max(axis=0), out=high)
    values = np.concatenate([low, high]).reshape(BANDS, BAND)
    return _mixed((_mixed(values) * IN_BAND).sum(axis=1, dtype=np.uint64) + BAND_SALT).view(np.int64)


def _signature(text: str) -> tuple[int, bytes | None, np.ndarray | None]:
    words = words_of(text)
    if not words:
        return 0, None, None
    shingles = _shingle_hashes(words)
    return len(shingles), xxhash.xxh3_128_digest(b" ".join(words)), band_keys(shingles)


@F.pandas_udf(SIGNATURE)
def signature(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_signature(text) for text in texts], columns=SIGNATURE.names)


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose sets are similar enough. A centre's rows follow each other, so its set is kept."""
    text, known = None, set()
    for batch in batches:
        linked = []
        for one, other in zip(batch["left_text"], batch["right_text"]):
            if one != text:
                text, known = one, shingles_of(one)
            own = shingles_of(other)
            common = len(known & own)
            linked.append(100 * common >= PERCENT * (len(known) + len(own) - common))
        yield batch.loc[linked, ["left", "right"]]


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (left, right) that are links, by their whole texts.

    Both joins are on ids of single documents; the many partners of a centre are a skewed side that
    adaptive execution splits.
    """
    right = texts.select(F.col("doc_id").alias("right"), F.col("text").alias("right_text"))
    left = texts.select(F.col("doc_id").alias("left"), F.col("text").alias("left_text"))
    whole = pairs.join(right, "right").join(left, "left").select("left", "right", "left_text", "right_text")
    return stored(whole.mapInPandas(_confirm, "left bigint, right bigint"), "verified")


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Rows with the component of a node, which is the node itself where it has no link."""
    own = labels.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(own, node, "left").withColumn(name, F.coalesce(name, node))


def _mixed_nodes(banded: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of buckets that hold several components: node, component, outside.

    ``outside`` says that in some bucket the document is not in the largest component. Of two
    documents in one bucket and different components, at least one is.
    """
    rows = stored(_labelled(banded, labels, "node", "component"), "banded-components")
    sizes = rows.groupBy("band", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("band").agg(
        F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("kinds")).where("kinds > 1")
    largest = stored(largest.select("band", F.col("top.component").alias("largest")), "mixed-buckets")
    return stored(rows.join(largest, "band").groupBy("node").agg(
        F.min("component").alias("component"), F.max(F.col("component") != F.col("largest")).alias("outside")), "mixed-nodes")


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The shingles of each text as numbers. ``part`` tells the texts of one id apart."""
    for batch in batches:
        own = [_shingle_hashes(words_of(text)) for text in batch["text"]]
        yield pd.DataFrame({
            "node": batch["node"], "component": batch["component"], "outside": batch["outside"],
            "part": [xxhash.xxh3_64_intdigest(text) >> 1 for text in batch["text"]],
            "size": [len(tokens) for tokens in own], "tokens": [tokens.view(np.int64) for tokens in own]})


TOKENS = "node bigint, component bigint, outside boolean, part bigint, size bigint, tokens array<bigint>"


def _prefixes(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The rarest quarter of each document's shingles, with their place from 0.

    Sorted by how many of these documents have a shingle, two sets that are similar enough must share
    one in the first quarter of both. Shingles of one document only come first and match nothing, so
    only their number matters.
    """
    whole = nodes.join(texts.withColumnRenamed("doc_id", "node"), "node")
    rows = whole.select("node", "component", "outside", "text").mapInPandas(_tokens, TOKENS)
    rows = stored(rows.withColumn("token", F.explode("tokens")).drop("tokens"), "tokens")
    shared = stored(rows.groupBy("token").agg(F.count("*").alias("documents")).where("documents > 1"), "shared-tokens")
    own = Window.partitionBy("node", "part")
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("documents", "token")) - 1
    return stored(rows.join(shared, "token").withColumn("place", place).where(4 * F.col("place") <= F.col("size")), "prefixes")


def _size_class(size: Column) -> Column:
    return F.floor(F.log(size) / F.lit(math.log(SIZE_STEP))).cast("int")


def _remaining_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs in different components that could be links by their prefixes, one end ``outside``.

    Two sets of a and b shingles are similar enough if they share at least 3 (a + b) / 7. If the first
    they share is at places i and j, they share at most a - i and b - j. So a shingle at place i can
    only matter towards sets of at most 7 (a - i) / 3 - a; matching by classes of size as well as by
    shingle leaves out all pairs beyond that, also where a shingle is in very many documents.
    """
    prefixes = _prefixes(nodes, texts)
    a, i = F.col("size"), F.col("place")
    most = F.least(F.floor(7 * (a - i) / 3) - a, F.floor(4 * a / 3))
    least = F.ceil(3 * a / 4)
    classes = F.sequence(_size_class(least), _size_class(F.greatest(most, least)))
    few = prefixes.where(F.col("outside") & (most >= least)).select(
        "token", F.explode(classes).alias("class"), F.col("node").alias("left"), F.col("component").alias("_left"),
        a.alias("a"), i.alias("i"))
    every = prefixes.select(
        "token", _size_class(a).alias("class"), F.col("node").alias("right"), F.col("component").alias("_right"),
        a.alias("b"), i.alias("j"), F.col("outside").alias("_both"))
    once = ~F.col("_both") | (F.col("left") < F.col("right"))
    enough = 7 * F.least(F.col("a") - F.col("i"), F.col("b") - F.col("j")) >= 3 * (F.col("a") + F.col("b"))
    found = few.join(every, ["token", "class"]).where((F.col("_left") != F.col("_right")) & once & enough)
    return stored(found.select("left", "right").distinct(), "remaining-pairs")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if the shingles they share are at least 75 % of their union. The component
    is the smallest id that can be reached over links; ``kept`` is true for that document alone. The
    search misses a pair at the threshold with probability 5e-6 and a closer one more rarely; what it
    finds is confirmed without estimate.

    A NULL or empty text has no shingles and is linked with nothing; one of fewer than five words is
    a single shingle. Rows that share an id count as one document with several texts. A NULL id is
    linked with nothing and has no component; such rows are kept. Other columns are ignored; no rows
    give no rows.
    """
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    signed = stored(rows.select("doc_id", signature("text").alias("_signed")).select("doc_id", "_signed.*"), "signatures")
    linkable = signed.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())

    # Equal word sequences become one node, named by their smallest id.
    classes = stored(linkable.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    members = stored(linkable.join(classes, "digest").select(
        "doc_id", "n_shingles", "node", F.when(F.col("doc_id") == F.col("node"), F.col("bands")).alias("bands")), "members")

    banded = members.where(F.col("bands").isNotNull()).select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
    buckets = stored(buckets.where(F.col("centre") < F.col("last")).select("band", "centre"), "buckets")
    banded = stored(banded.join(buckets, "band").select("band", "node", "centre").distinct(), "shared-bands")
    pairs = stored(banded.where(F.col("node") != F.col("centre")).select(
        F.col("centre").alias("left"), F.col("node").alias("right")).distinct(), "centre-pairs")
    texts = stored(rows.join(banded.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi"), "candidate-texts")

    # An id that stands with several texts joins their nodes.
    several = stored(members.groupBy("doc_id").agg(F.min("node").alias("left"), F.max("node").alias("last")).where(
        F.col("left") < F.col("last")).select("doc_id", "left"), "several-texts")
    same_id = members.join(several, "doc_id").select("left", F.col("node").alias("right")).where("left != right").distinct()

    links = _verified(pairs, texts).unionByName(same_id)
    labels = components(links, "left", "right")
    late = _verified(_remaining_pairs(_mixed_nodes(banded.select("band", "node"), labels), texts), texts)
    if not late.isEmpty():
        labels = components(links.unionByName(late), "left", "right")

    linked = _labelled(members.select("doc_id", "n_shingles", "node"), labels, "node", "component_id")
    alone = signed.where(F.col("doc_id").isNull() | F.col("digest").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id").unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents of which ``near_duplicates`` keeps one per component; columns as they were.

    Of rows that share a kept id one stays. Rows with a NULL id all stay.
    """
    found = stored(near_duplicates(docs), "near-duplicates")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"].cast("bigint") == F.col("_gone"), "left_anti")
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("_again")), "repeated-ids")
    if repeated.isEmpty():
        return kept
    same = kept["doc_id"].cast("bigint") == repeated["_again"]
    single = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, same, "left_anti").unionByName(single)
