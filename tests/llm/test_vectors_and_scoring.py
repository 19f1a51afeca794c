"""Clustering, whitening and n-gram scoring against brute force on small tables and the test data."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from oracle_check import differences, duck
from pyspark.sql import functions as F

from viewlog.llm import centroids, hash_arrays, kneser_ney, whitening, word_hashes
from viewlog.llm.queries import all_queries, all_sql
from viewlog.llm.tables import importable

VECTORS = "vec_id bigint, embedding array<double>, label int, cluster string, x int, hash string"
DOCS = "doc_id bigint, text string, lang string, held_out string, count int, w0 string"


def vectors(spark, rows):
    return spark.createDataFrame([(vec_id, vector, 0, "c", 1, "h") for vec_id, vector in rows], VECTORS)


def docs(spark, rows):
    return spark.createDataFrame([(doc_id, text, "en", "h", 1, "w") for doc_id, text in rows], DOCS)


# --- Centroid clustering --------------------------------------------------------------------------


def plain_clusters(rows, clusters, rounds, size, seed=centroids.SEED):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = {i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i, _ in kept}
    centres = [list(x) for _, x in sorted(kept, key=lambda row: (name[row[0]], row[1]))[:clusters]]

    def best(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        owners = [best(x)[1] for _, x in kept]
        for n in range(len(centres)):
            own = [x for (_, x), owner in zip(kept, owners) if owner == n]
            if own:
                centres[n] = [sum(column) // len(own) for column in zip(*own)]
    found = [(i, *best(x)) for i, x in kept]
    inertia = Counter()
    for _, distance, n in found:
        inertia[n] += distance
    return sorted((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
                  for i, d, n in found)


@pytest.mark.parametrize("clusters", [1, 3, 50])
def test_clusters_equal_brute_force(spark, clusters):
    chance = np.random.default_rng(clusters)
    rows = [(n, [float(x) for x in chance.normal(size=4)]) for n in range(40)]
    rows += [(100, None), (101, []), (102, [1.0]), (103, [1.0, None, 0.0, 0.0]), (104, [math.nan, 0.0, 0.0, 0.0]),
             (105, [math.inf, 0.0, 0.0, 0.0]), (7, rows[7][1]), (8, rows[3][1]), (9, [0.0] * 4), (10, [-0.0] * 4)]
    found = centroids.cluster(vectors(spark, rows), size=4, clusters=clusters)
    assert sorted(map(tuple, found.collect())) == plain_clusters(rows, clusters, 3, 4)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_equal_vectors_share_the_first_cluster(spark):
    found = centroids.cluster(vectors(spark, [(n, [0.5, 0.25]) for n in range(30)]), size=2).collect()
    assert {(row["cluster"], row["distance"], row["inertia"]) for row in found} == {(0, 0, 0)} and len(found) == 30


def test_vectors_without_id_and_huge_ones(spark):
    rows = [(None, [1e300, -1e300]), (1, [1e300, -1e300]), (2, [0.0, 0.0])]
    found = {row["vec_id"]: row for row in centroids.cluster(vectors(spark, rows), size=2, clusters=2).collect()}
    assert found[None]["cluster"] == found[1]["cluster"] != found[2]["cluster"]
    assert all(row["distance"] == 0 for row in found.values())
    apart = centroids.cluster(vectors(spark, rows), size=2, clusters=1, rounds=0).collect()
    assert max(row["distance"] for row in apart) == 2 * centroids.MOST**2


def test_clustering_no_rows(spark):
    assert centroids.cluster(vectors(spark, []), size=2).collect() == []
    assert centroids.cluster(vectors(spark, [(1, None)]), size=2).collect() == []


def test_clusters_of_the_test_data_equal_sql(spark):
    name = "op11_centroid_clustering"
    assert differences(spark, duck(SF_DIR), SF_DIR, all_queries()[name], all_sql()[name]) == ""


# --- Whitening ------------------------------------------------------------------------------------


def plain_whitening(rows, components):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    covariance = (centred.T @ centred).astype(float) / n**3
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (centred / n).astype(float) @ vectors[:, :components] / np.sqrt(values[:components])
    return (centred * centred).sum(axis=1), white, values / values.sum()


def test_whitening_equals_brute_force(spark):
    chance = np.random.default_rng(3)
    turn = chance.normal(size=(6, 6))
    good = [(n, [float(c) for c in chance.normal(size=6) @ turn]) for n in range(300)]
    bad = [(900, None), (901, [None] * 6), (902, [math.nan] * 6), (903, [0.0, 0.0, 0.0, 0.0, 0.0, math.inf]), (904, []), (905, [1.0])]
    found = whitening.whiten(vectors(spark, good + bad), components=4).toPandas()
    deviation, white, explained = plain_whitening(good, 4)
    assert len(found) == 4 * len(good) and set(found["n"]) == {300}
    table = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table * signs - white).max() < 1e-9
    assert found[found["component"] == 1].sort_values("vec_id")["deviation"].tolist() == list(deviation)
    assert np.allclose(found.drop_duplicates("component").sort_values("component")["explained"], explained[:4], rtol=1e-9)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-9


def test_whitening_the_test_data(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = all_queries()["op12_embedding_whitening"](spark, SF_DIR).toPandas()
    deviation, white, _ = plain_whitening([(row[0], [float(c) for c in row[1]]) for row in rows], 32)
    order = [row[0] for row in rows]
    table = found.pivot(index="vec_id", columns="component", values="whitened").loc[order].to_numpy()
    assert np.abs(np.abs(table) - np.abs(white)).max() < 1e-8
    assert found[found["component"] == 9].set_index("vec_id").loc[order]["deviation"].tolist() == list(deviation)
    assert found["identity_error"].max() < 1e-4


@pytest.mark.parametrize("peak", [3, 1 << 30, 1 << 41])
def test_sums_are_exact_whatever_their_size(peak):
    block = np.random.default_rng(1).integers(-peak, peak, size=(50, 5))
    plain = block.astype(object)
    assert list(whitening.plain_sums(block)) == list(plain.sum(axis=0))
    pairs = [plain[:, a] + plain[:, b] for a in range(5) for b in range(a + 1, 5)]
    wanted = [(column**2).sum() for column in [*plain.T, *pairs]]
    assert list(whitening.squared_sums(block)) == wanted
    sums = list(plain.sum(axis=0))
    whole = [total // 50 for total in sums]
    matrix = whitening.covariance(50, [total % 50 for total in sums], list(whitening.squared_sums(block - np.array(whole, dtype=np.int64))))
    centred = 50 * plain - plain.sum(axis=0)
    exact = [[int(value) / 50**3 for value in row] for row in centred.T @ centred]
    assert np.array_equal(matrix, np.array(exact))


def test_whitening_without_variance_mixed_lengths_and_no_rows(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(row["component"], row["n"], row["deviation"], row["whitened"], row["explained"]) for row in one] == [
        (1, 1, 0, None, None), (2, 1, 0, None, None)]
    flat = whitening.whiten(vectors(spark, [(n, [n / 8, 0.5]) for n in range(8)] + [(None, [2.0, 0.5]), (20, [1.0])])).collect()
    assert len(flat) == 18 and {row["component"] for row in flat if row["whitened"] is None} == {2}
    assert {round(row["explained"], 12) for row in flat if row["component"] == 1} == {1.0}
    huge = whitening.whiten(vectors(spark, [(n, [1e200 * n, float(n % 3)]) for n in range(9)])).collect()
    assert all(row["identity_error"] < 1e-4 for row in huge)


# --- Word hashes and hash tables ------------------------------------------------------------------


def plain_words(text):
    return (text or "").encode().lower().split()


TEXTS = ["", " ", "one", " One\tTWO\nthree\x0b\x0cfour\r", "ünï ÜNÏ x", "a b", "x" * 9000 + " y", "word " * 30, "tail"]


def test_words_are_told_apart_as_by_splitting(monkeypatch):
    monkeypatch.setattr(word_hashes, "PIECE", 64)
    monkeypatch.setattr(word_hashes, "LONG", 40)
    texts = TEXTS + ["long " * 100 + "z" * 500 + " end " + "q" * 1000, "w" * 700]
    hashes, words = [], []
    for piece, row in word_hashes.pieces(pa.array(texts)):
        hashes += list(zip(row.tolist(), piece.tolist()))
    for number, text in enumerate(texts):
        words += [(number, word) for word in [*plain_words(text), b""]]
    assert len(hashes) == len(words) and [row for row, _ in hashes] == [row for row, _ in words]
    named = dict(zip((value for _, value in hashes), (word for _, word in words)))
    assert len(named) == len({word for _, word in words})
    assert all(named[value] == word for (_, value), (_, word) in zip(hashes, words))


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
@pytest.mark.parametrize("order", [1, 2, 4])
def test_blocks_hold_every_word_after_its_context(order, limit):
    grams, wanted = [], []
    for block in word_hashes.blocks([pa.array(TEXTS[:4]), pa.array(TEXTS[4:])], order, limit):
        words = block.hashes[block.local]
        for end in np.flatnonzero(block.row >= 0):
            grams.append((int(block.row[end]), *words[end - order + 1:end + 1].tolist()))
    for piece, row in word_hashes.pieces(pa.array(TEXTS)):
        for number in sorted(set(row.tolist())):
            own = [word_hashes.START] * (order - 1) + piece[row == number].tolist()
            wanted += [(number, *own[end - order + 1:end + 1]) for end in range(order - 1, len(own))]
    assert grams == wanted


def test_hashes_are_those_of_the_engine(spark):
    rows = spark.range(500).select((F.col("id") * 7919 - 5).alias("a"), F.xxhash64("id").alias("b")).withColumns(
        {"one": F.xxhash64("a"), "two": F.xxhash64("a", "b")}).toPandas()
    assert (hash_arrays.hash_numbers([rows["a"].to_numpy()]) == rows["one"]).all()
    assert (hash_arrays.hash_numbers([rows["a"].to_numpy(), rows["b"].to_numpy()]) == rows["two"]).all()


@pytest.mark.parametrize("copied", [False, True])
@pytest.mark.parametrize("bits", [0, 3])
def test_hash_table_finds_what_was_stored(spark, tmp_path, bits, copied):
    rows = spark.range(1000).select(F.xxhash64("id").alias("hash"), F.col("id").alias("value"))
    target = hash_arrays.HashTable(f"file://{tmp_path}/t{copied}{bits}", f"numbers{copied}{bits}", bits, (("value", "bigint"),))
    importable(lambda spark: hash_arrays.store(rows, target))(spark)
    importable(lambda spark: hash_arrays.store(rows, target))(spark)  # a repeated task replaces what is there
    if copied:
        for path in (tmp_path / f"t{copied}{bits}").iterdir():
            spark.sparkContext.addFile(str(path))
        target = hash_arrays.HashTable(target.folder, target.name, bits, target.columns, copied=True)
    known = rows.toPandas().sort_values("hash")
    asked = np.concatenate([known["hash"].to_numpy(), [5, 5, 6]])
    place, value = hash_arrays.Reader(target).find(asked, "value")
    assert place.tolist() == [*range(1000), -1, -1, -1]
    assert value.tolist() == [*known["value"], 0, 0, 0]


# --- N-gram scoring -------------------------------------------------------------------------------


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


class PlainModel:
    """The same model, counted in dictionaries."""

    def __init__(self, rows, order):
        train = [[*plain_words(text), b""] for doc_id, text in rows if not is_held_out(doc_id)]
        self.unigrams = Counter(word for words in train for word in words)
        self.order, self.levels = order, {}
        grams = Counter()
        for words in train:
            padded = ["<s>"] * (order - 1) + words
            grams.update(tuple(padded[n:n + order]) for n in range(len(words)))
        for length in range(order, 0, -1):
            contexts = defaultdict(list)
            for gram, count in grams.items():
                contexts[gram[:-1]].append(count)
            seen = [sum(count == n for count in grams.values()) for n in (1, 2, 3, 4)]
            self.levels[length] = grams, contexts, kneser_ney.discounts_of(seen)
            below = Counter()
            for gram, count in grams.items():
                below[gram[1:]] += count if gram[1:2] == ("<s>",) else 1
            grams = below

    def probability(self, gram):
        if not gram:
            return 1 / (len(self.unigrams) + 1)
        grams, contexts, discounts = self.levels[len(gram)]
        lower, counts = self.probability(gram[1:]), contexts.get(gram[:-1])
        if not counts:
            return lower
        taken = [0.0, *discounts]
        count = grams.get(gram, 0)
        return (count - taken[min(count, 3)]) / sum(counts) + sum(taken[min(c, 3)] for c in counts) / sum(counts) * lower

    def scores(self, text):
        words = [*plain_words(text), b""]
        padded = ["<s>"] * (self.order - 1) + words
        total, known = sum(self.unigrams.values()), len(self.unigrams)
        base = sum(math.log10((self.unigrams[w] + 0.1) / (total + 0.1 * (known + 1))) for w in words)
        score = sum(math.log10(self.probability(tuple(padded[n:n + self.order]))) for n in range(len(words)))
        return len(words), sum(w in self.unigrams for w in words), total, base, score


def scored(spark, frame, order):
    return importable(lambda spark: kneser_ney.scores(frame, order))(spark).collect()


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    chance = np.random.default_rng(order)
    words = [f"W{int(n)}" for n in chance.zipf(1.6, 3000) % 60]
    rows = [(n, " ".join(words[n * 40:n * 40 + 10 + n])) for n in range(60)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, "w1 never"), (203, "été ÉTÉ w1"), (204, "z" * 6000 + " w1"), (3, rows[3][1])]
    model = PlainModel(rows, order)
    found = {(row["doc_id"], row["n_tokens"]): row for row in scored(spark, docs(spark, rows), order)}
    for doc_id, text in rows:
        wanted = model.scores(text)
        row = found[(doc_id, wanted[0])]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == wanted[:3]
        assert row["base_score"] == pytest.approx(wanted[3], rel=1e-9)
        assert row["score"] == pytest.approx(wanted[4], rel=1e-6)  # stored counts are single precision
        assert row["held_out"] == is_held_out(doc_id)
        assert row["perplexity"] == pytest.approx(10 ** (-wanted[4] / wanted[0]), rel=1e-5)


def test_probabilities_add_up_to_one():
    rows = [(n, text) for n, text in enumerate(["a b c a b", "b c d", "a a a b", "c d e f a", "b a d"] * 2)]
    model = PlainModel(rows, 2)
    known = [*model.unigrams]
    for before in [*known, "<s>", b"never"]:
        total = sum(model.probability((before, word)) for word in known) + model.probability((before, b"unknown"))
        assert total == pytest.approx(1)


def test_scoring_the_test_data(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    model = PlainModel(rows, kneser_ney.ORDER)
    found = {row["doc_id"]: row for row in all_queries()["op13_lm_scoring"](spark, SF_DIR).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        wanted, row = model.scores(text), found[doc_id]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == wanted[:3]
        assert row["base_score"] == pytest.approx(wanted[3], rel=1e-9) and row["score"] == pytest.approx(wanted[4], rel=1e-6)
    unseen = [row for row in found.values() if row["held_out"]]
    assert sum(row["score"] for row in unseen) > sum(row["base_score"] for row in unseen)


def test_scoring_no_rows_and_no_training(spark):
    assert scored(spark, docs(spark, []), 2) == []
    one, = scored(spark, docs(spark, [(None, "a b")]), 2)
    assert (one["n_tokens"], one["n_known"], one["train_tokens"], one["base_score"], one["score"]) == (3, 0, 0, 0.0, 0.0)
