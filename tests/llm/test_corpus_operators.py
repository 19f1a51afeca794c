"""Operators that relate documents to each other, against brute force on small tables and the test data."""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from viewlog.llm import components, near_dup, packing, sharding, vector_dup
from viewlog.llm.queries import all_queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, band string, Shard int"


def docs(spark, *rows):
    return spark.createDataFrame([(doc_id, text, "en", "s", None, "b", 7) for doc_id, text in rows], SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def reached(nodes, links):
    """Smallest reachable node, by the plainest union-find."""
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for one, other in links:
        a, b = root(one), root(other)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


# --- Components -----------------------------------------------------------------------------------


@pytest.mark.parametrize("links", [
    [], [(1, 1), (None, 2)], [(5, 4), (4, 5), (4, 3), (9, 8)], [(n, n + 1) for n in range(40)],
    [(0, n) for n in range(1, 30)], [(n, 30 + n % 7) for n in range(30)] + [(31, 33), (36, 30)],
])
def test_components(spark, links):
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()
    proper = [pair for pair in links if None not in pair and pair[0] != pair[1]]
    wanted = reached({node for pair in proper for node in pair}, proper)
    assert {row["node"]: row["component"] for row in found} == wanted
    assert len(found) == len(wanted)


def test_components_of_a_long_path_of_shuffled_ids(spark):
    ids = [int(n) for n in np.random.default_rng(5).permutation(1000)]
    found = components.components(spark.createDataFrame(list(zip(ids, ids[1:])), "a bigint, b bigint"), "a", "b").collect()
    assert {row["node"]: row["component"] for row in found} == dict.fromkeys(range(1000), 0)


# --- Near-duplicate documents ---------------------------------------------------------------------


def plain_groups(rows):
    """All pairs of all texts; rows of one id count as one document."""
    sets = [(doc_id, near_dup.shingles_of(text or "")) for doc_id, text in rows if doc_id is not None]
    links = [
        (a, b) for (a, left), (b, right) in combinations(sets, 2)
        if left and right and 100 * len(left & right) >= 75 * len(left | right)]
    return reached({doc_id for doc_id, _ in sets}, links), sets


def changed(words, count, seed):
    """Words with ``count`` of them replaced."""
    chance = np.random.default_rng(seed)
    out = list(words)
    for place in chance.choice(len(words), count, replace=False):
        out[place] = f"new{seed}x{place}"
    return " ".join(out)


def near_dup_rows():
    words = [f"w{n % 97}q{n}" for n in range(200)]
    rows = [(100 + n, changed(words, n % 7, n)) for n in range(60)]  # a family around the threshold
    rows += [(300 + n, " ".join(words).upper()) for n in range(20)]  # exact copies but for case
    rows += [(400 + n, " ".join(words[n * 3:n * 3 + 120])) for n in range(25)]  # a chain
    rows += [(500, None), (501, ""), (502, " \t"), (503, "one two"), (504, "One  TWO\n"), (505, "one two three")]
    rows += [(600, "a b c d e"), (600, "f g h i j"), (601, "f g h i j"), (602, "A b c D e"), (None, "a b c d e")]
    rows += [(700, "x y z v w " * 300), (701, "x y z v w " * 500), (702, "É é É é É"), (703, "é é é é é")]
    return rows


def test_near_duplicates_against_all_pairs(spark):
    rows = near_dup_rows()
    found = near_dup.near_duplicates(docs(spark, *rows)).collect()
    groups, _ = plain_groups(rows)
    assert len(found) == len(rows)
    for row in found:
        assert row["component_id"] == (None if row["doc_id"] is None else groups[row["doc_id"]]), row
        assert row["kept"] == (row["doc_id"] is None or row["doc_id"] == row["component_id"])
    sizes = sorted(row["n_shingles"] for row in found)
    assert sizes == sorted(len(near_dup.shingles_of(text or "")) for _, text in rows)


def test_near_duplicates_of_the_test_data(spark):
    rows = [(row["doc_id"], row["text"]) for row in documents(spark).collect()]
    found = {row["doc_id"]: row for row in all_queries()["op8_minhash_near_dedup"](spark, SF_DIR).collect()}
    groups, sets = plain_groups(rows)
    assert {doc_id: row["component_id"] for doc_id, row in found.items()} == groups
    assert {doc_id: row["n_shingles"] for doc_id, row in found.items()} == {doc_id: len(own) for doc_id, own in sets}
    assert any(row["component_id"] != doc_id for doc_id, row in found.items())


def test_signatures_estimate_the_similarity():
    left = np.random.default_rng(1).integers(0, 2**63, 4000, dtype=np.uint64)
    right = np.concatenate([left[:3400], np.random.default_rng(2).integers(0, 2**63, 600, dtype=np.uint64)])
    similarity = 3400 / 4600
    both = [near_dup.band_keys(np.unique(near_dup._mixed(one))) for one in (left, right)]
    assert len(both[0]) == near_dup.BANDS
    shared = (both[0] == both[1]).mean()
    assert abs(shared - similarity ** near_dup.BAND) < 0.25 and shared > 0


def test_dedup_stage_keeps_one_row_of_a_group(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "other words are here now"),
            (3, "other words are here now"), (None, "a b c d e f"), (4, None)]
    kept = near_dup.without_near_duplicates(docs(spark, *rows))
    assert kept.columns == [field.split()[0] for field in SCHEMA.split(", ")]
    assert sorted(str(row["doc_id"]) for row in kept.collect()) == ["1", "3", "4", "None"]


# --- Vectors --------------------------------------------------------------------------------------


def vectors(spark, rows):
    plain = [(vec_id, vector and [x if x is None else float(x) for x in vector], 0, 5) for vec_id, vector in rows]
    return spark.createDataFrame(plain,
                                 "vec_id bigint, embedding array<double>, label int, shard int")


def plain_vectors(rows, cosine=0.95):
    usable = [(number, vec_id, vector) for number, (vec_id, vector) in enumerate(rows)
              if vector and vec_id is not None and None not in vector and np.isfinite(np.array(vector, float)).all() and any(vector)]
    links = {number: 0 for number in range(len(rows))}
    pairs = []
    for (i, a, left), (j, b, right) in combinations(usable, 2):
        if len(left) == len(right) and vector_dup._unit(np.array([left]))[0] @ vector_dup._unit(np.array([right]))[0] >= cosine:
            links[i] += 1
            links[j] += 1
            pairs.append((a, b))
    return links, reached({vec_id for vec_id, _ in rows if vec_id is not None}, pairs)


def test_vectors_against_all_pairs(spark):
    chance = np.random.default_rng(6)
    base = chance.normal(size=(6, 16))
    rows = [(n, list(base[n % 6] + chance.normal(0, 0.08, 16))) for n in range(150)]
    rows += [(200 + n, list(chance.normal(size=16))) for n in range(150)]
    rows += [(400 + n, list(base[0])) for n in range(9)] + [(450, list(base[0] * 1e200)), (451, list(base[0] * 1e-200))]
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [1.0] * 15 + [None]),
             (505, [float("inf")] + [1.0] * 15), (506, [1.0, 1.0]), (507, [1.0, 1.0]), (508, [2.0])]
    found = {row["vec_id"]: row for row in vector_dup.near_duplicates(vectors(spark, rows), slice_rows=100).collect()}
    links, groups = plain_vectors(rows)
    assert len(found) == len(rows)
    for number, (vec_id, _) in enumerate(rows):
        assert found[vec_id]["n_links"] == links[number], vec_id
        assert found[vec_id]["component_id"] == groups[vec_id]
        assert found[vec_id]["kept"] == (vec_id == groups[vec_id])


def test_vectors_without_rows_and_with_a_null_id(spark):
    assert vector_dup.near_duplicates(vectors(spark, [])).collect() == []
    found = vector_dup.near_duplicates(vectors(spark, [(None, [1.0, 0.0]), (1, [1.0, 0.0])])).collect()
    assert sorted((str(row["vec_id"]), row["n_links"], row["kept"]) for row in found) == [("1", 0, True), ("None", 0, True)]


def test_embeddings_of_the_test_data(spark):
    rows = [(row["vec_id"], row["embedding"]) for row in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    found = {row["vec_id"]: row for row in all_queries()["op10_embedding_near_dedup"](spark, SF_DIR).collect()}
    links, groups = plain_vectors(rows)
    true = sum(links.values())
    assert sum(row["n_links"] for row in found.values()) >= 0.98 * true
    assert all(found[vec_id]["n_links"] <= links[number] for number, (vec_id, _) in enumerate(rows))
    assert sum(found[vec_id]["component_id"] == group for vec_id, group in groups.items()) >= 0.98 * len(groups)


def test_graph_recall_and_layers():
    chance = np.random.default_rng(7)
    exact = vector_dup._unit(chance.normal(size=(3000, 24)))
    graph = vector_dup.Graph(exact)
    assert graph.sizes == [3000, 188, 12]
    queries = exact[:200].astype(np.float32)
    nodes, _ = graph.search(queries, 64)
    best = np.argsort(-(queries @ graph.vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(nodes, best)]) > 0.9


class Forgetful:
    """A search that finds the first group at any width, and of the others nothing but the query below 128."""

    def __init__(self, exact, first):
        self.exact, self.first = exact, first

    def search(self, queries, beam):
        near = queries @ self.exact.T
        best = np.argsort(-near, axis=1, kind="stable")[:, :beam]
        near = np.take_along_axis(near, best, axis=1)
        if beam < 128:
            near[(best[:, 0] >= self.first)[:, None] & (np.arange(beam) > 0)] = -np.inf
        return best, near


@pytest.mark.parametrize("first", [0, 200])
def test_audit_sees_small_groups(first):
    chance = np.random.default_rng(8)
    pairs = np.repeat(chance.normal(size=(100, 32)), 2, axis=0) + chance.normal(0, 0.01, (200, 32))
    alone = chance.normal(size=(2000, 32))
    exact = vector_dup._unit(np.concatenate([np.ones((first, 32)) + chance.normal(0, 0.01, (first, 32)), pairs, alone]))
    assert vector_dup._audit(Forgetful(exact, first), exact, exact, 0.95, np.arange(len(exact))) >= 128


def test_no_row_holds_a_graph_and_graphs_have_bounded_bytes(spark, monkeypatch):
    widest, built, stored = {}, [], vector_dup.stored

    def noted(frame, name):
        frame = stored(frame, name)
        widest[name] = frame.agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
        if name == "graphs":
            built.extend(frame.collect())
        return frame

    monkeypatch.setattr(vector_dup, "stored", noted)
    monkeypatch.setattr(vector_dup, "SHARD_BYTES", 100 * 24 * 4, raising=False)
    chance = np.random.default_rng(9)
    base = chance.normal(size=(500, 24))
    rows = [(n, list(vector)) for n, vector in enumerate(np.concatenate([base, base + chance.normal(0, 0.01, base.shape)]))]
    rows += [(2000, [1.0, 2.0]), (2001, [1.0, 2.0])]
    found = {row["vec_id"]: row for row in vector_dup.near_duplicates(vectors(spark, rows), shards=1, slice_rows=64).collect()}
    assert max(widest.values()) < 1500  # a vector of 24 doubles in decimal has 500
    assert sum(row["rows"] for row in built) == 1001 and max(row["rows"] for row in built) < 200
    assert all(found[n]["component_id"] == n % 500 and found[n]["n_links"] == 1 for n in range(1000))
    assert found[2000]["n_links"] == 1 and found[2001]["component_id"] == 2000


def test_single_and_double_precision_give_the_same_groups(spark):
    chance = np.random.default_rng(10)
    base = chance.normal(size=(40, 8)).astype(np.float32)
    rows = [(n, [float(x) for x in vector]) for n, vector in enumerate(np.concatenate([base, base, base * np.float32(0.25)]))]
    single = vectors(spark, rows).select("vec_id", F.col("embedding").cast("array<float>"))
    one, two = (sorted(map(tuple, vector_dup.near_duplicates(frame).collect())) for frame in (vectors(spark, rows), single))
    assert one == two and len({row[2] for row in one}) == len({n % 40 for n in range(120)})


class Recorded(Forgetful):
    """A search that finds everything and keeps how wide it was asked to be."""

    def __init__(self, exact):
        super().__init__(exact, len(exact))
        self.beams = []

    def search(self, queries, beam):
        self.beams.append(beam)
        return super().search(queries, beam)


def test_no_beam_grows_with_a_group():
    chance = np.random.default_rng(11)
    exact = vector_dup._unit(np.concatenate([np.ones((1500, 16)) + chance.normal(0, 0.01, (1500, 16)), chance.normal(size=(500, 16))]))
    graph = Recorded(exact)
    pairs = sum(len(row) for row, _ in vector_dup._links(graph, exact, exact[1400:1600], 0.95, vector_dup.FIRST_BEAM))
    assert pairs == (exact[1400:1600] @ exact.T >= 0.95).sum()
    assert max(graph.beams) < 256


@pytest.mark.parametrize("copied", [False, True])
def test_arrays_of_graphs(spark, tmp_path, copied):
    graphs = vector_dup.Graphs(f"file://{tmp_path}/graphs{copied}", copied)
    wanted = np.arange(12, dtype=np.float32).reshape(4, 3)
    for _ in range(2):  # a repeated task replaces what is there
        graphs.put(3, 5, "vector", wanted)
    files = sorted((tmp_path / f"graphs{copied}").iterdir())
    assert len(files) == 1
    if copied:
        spark.sparkContext.addFile(str(files[0]))
    read = spark.sparkContext.parallelize([0], 1).map(lambda _: graphs.get(3, 5, "vector")[1:3].tolist()).first()
    assert read == wanted[1:3].tolist()


def test_full_nodes_keep_edges_that_lead_out():
    graph = vector_dup.Graph.__new__(vector_dup.Graph)
    graph.vectors = vector_dup._unit(np.array([[1, 0.01, 0], [1, 0.02, 0], [1, 0.03, 0], [1, 0, 1], [1, 0.025, 0]])).astype(np.float32)
    near = graph.vectors @ graph.vectors[0]
    graph.layers, close = [np.array([[1, 2, 3]], dtype=np.int32)], near[None, [1, 2, 3]].copy()
    graph._connect(0, close, np.array([0]), np.array([4]), near[[4]])
    assert 3 in graph.layers[0][0]


def test_disjoint_sets():
    chance = np.random.default_rng(8)
    pairs = chance.integers(0, 300, (200, 2))
    groups = vector_dup.Groups(300)
    for part in np.array_split(pairs, 7):
        groups.merge(part[:, 0], part[:, 1])
    wanted = reached(range(300), [tuple(pair) for pair in pairs.tolist()])
    assert groups.roots(np.arange(300)).tolist() == [wanted[n] for n in range(300)]


# --- Shards ---------------------------------------------------------------------------------------


def plain_shards(rows, shards):
    sized = sorted(((doc_id is not None, doc_id or 0, len((text or "").encode()) + 8, zlib.crc32((text or "").encode()))
                    for doc_id, text in rows))
    total, start, slots, out = sum(row[2] for row in sized), 0, {}, []
    for known, doc_id, size, crc in sized:
        shard = min((2 * start + size) * shards // (2 * total), shards - 1)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((doc_id if known else None, size, crc, "bytes", shard, slots[shard], None, start))
        start += size
    return out


def shard_rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=lambda row: row[-1])


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards_of_a_small_table(spark, shards):
    rows = [(n, "é" * (n * 7 % 23)) for n in range(50)] + [(7, "same")] * 40 + [(None, None), (60, ""), (61, "x" * 5000)]
    assert shard_rows(sharding.byte_shards(docs(spark, *rows), shards)) == plain_shards(rows, shards)


def test_shards_of_the_test_data(spark):
    rows = [(row["doc_id"], row["text"]) for row in documents(spark).collect()]
    found = shard_rows(all_queries()["op3_sharding"](spark, SF_DIR))
    assert found == plain_shards(rows, 24)
    sizes = [sum(row[1] for row in found if row[4] == shard) for shard in range(24)]
    assert max(sizes) - min(sizes) <= 2 * max(row[1] for row in found)


def test_shards_of_rows_that_stand_often(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    rows = [(1, "a")] * 7 + [(2, "bcd")] * 50 + [(None, None)] * 29 + [(3, "e")] * 8 + [(4, "f")]
    assert shard_rows(sharding.byte_shards(docs(spark, *rows), 5)) == plain_shards(rows, 5)


def test_shards_of_one_row_repeated(spark):
    one = spark.range(400_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    found = sharding.byte_shards(one, 4).groupBy("shard").agg(
        F.count("*").alias("rows"), F.count_distinct("slot").alias("slots"), F.max("slot").alias("last"))
    assert sorted(tuple(row) for row in found.collect()) == [(n, 100_000, 100_000, 99_999) for n in range(4)]


def test_shards_of_nothing(spark):
    assert sharding.byte_shards(documents(spark).limit(0)).collect() == []
    with pytest.raises(ValueError):
        sharding.byte_shards(documents(spark), 0)


# --- Packing --------------------------------------------------------------------------------------


def assert_packed(found, rows, capacities):
    """Every word is in one place, no bin overflows or overlaps, and no bin could be smaller."""
    words = sorted((str(doc_id), len((text or "").encode().split())) for doc_id, text in rows)
    bins: dict = {}
    total: dict = {}
    starts = 0
    for row in found:
        total[str(row["doc_id"])] = total.get(str(row["doc_id"]), 0) + row["n_words"]
        starts += row["piece"] == 0
        if row["n_words"] == 0:
            assert row["bin_id"] is None and row["capacity"] is None
        else:
            bins.setdefault(row["bin_id"], []).append(row)
    wanted: dict = {}
    for doc_id, count in words:
        wanted[doc_id] = wanted.get(doc_id, 0) + count
    assert total == wanted and starts == len(rows)
    for inside in bins.values():
        end = 0
        for row in sorted(inside, key=lambda row: row["bin_offset"]):
            assert row["bin_offset"] == end
            end += row["n_words"]
        assert {row["bin_words"] for row in inside} == {end}
        assert {row["capacity"] for row in inside} == {min(c for c in capacities if c >= end)}
    return bins


def test_packing_of_a_small_table(spark):
    rows = [(n, "w " * (n * 13 % 41)) for n in range(120)] + [(5, "same words here")] * 30 + [(None, "a b"), (900, None), (901, "v " * 137)]
    found = packing.pack(docs(spark, *rows), (8, 16, 32), group_pieces=50).collect()
    assert_packed(found, rows, (8, 16, 32))
    assert [row["n_words"] for row in sorted((r for r in found if r["doc_id"] == 901), key=lambda r: r["piece"])] == [32] * 4 + [9]


def test_packing_of_rows_that_stand_very_often(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 7)
    rows = [(None, "")] * 50 + [(None, "a b")] * 7 + [(1, "a b c")] * 64 + [(2, None)] * 8 + [(3, "w " * 20)] * 15
    assert_packed(packing.pack(docs(spark, *rows), (8, 16), group_pieces=20).collect(), rows, (8, 16))
    monkeypatch.setattr(packing, "RUN", 10_000)
    one = spark.range(3_000_000).selectExpr("cast(null as bigint) doc_id", "'' text")
    assert packing.pack(one).count() == 3_000_000


def test_packing_of_the_test_data(spark):
    rows = [(row["doc_id"], row["text"]) for row in documents(spark).collect()]
    found = all_queries()["op1_best_fit_packing"](spark, SF_DIR).collect()
    bins = assert_packed(found, rows, packing.CAPACITIES)
    used = sum(row["n_words"] for row in found)
    room = sum(inside[0]["capacity"] for inside in bins.values())
    assert used >= 0.95 * room
    assert packing.pack(documents(spark).limit(0)).collect() == []


def test_best_fit_finds_the_joint_optimum_of_small_cases():
    costs = {10: 10.5, 6: 6.2}
    place, capacity = packing.best_fit(np.array([6, 5, 5, 4]), costs)
    assert sorted(capacity.tolist()) == [10, 10] and len(set(place.tolist())) == 2
    place, capacity = packing.best_fit(np.array([6, 6, 6]), costs)
    assert capacity.tolist() == [6, 6, 6]
    with pytest.raises(ValueError):
        packing.best_fit(np.array([11]), costs)


# --- Pipeline -------------------------------------------------------------------------------------


def test_pipeline_runs_its_stages(spark):
    large = SF_DIR.replace("0.001", "0.01")
    rows = spark.read.parquet(f"{large}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "language_id", "minhash_near_dedup", "best_fit_packing"]
    kept = rows.withColumnRenamed("n_chars", "_Says")  # a clash with a helper column
    ids = set()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {row["doc_id"]: row["text"] for row in kept.collect()}
        kept = stage(spark, kept, large)
        assert kept.columns == ["doc_id", "text", "lang", "source", "_Says"]
        ids = {row["doc_id"] for row in kept.collect()}
        assert ids < set(before) or name == "language_id"
        if name == "minhash_near_dedup":
            groups, _ = plain_groups(list(before.items()))
            assert ids == {doc_id for doc_id, group in groups.items() if doc_id == group}
    packed = corpus_pipeline.run(spark, large).collect()
    assert {row["doc_id"] for row in packed} == ids


def spoken(spark, lang_of):
    """Documents of two invented languages, then one of each and one of an unknown script."""
    chance = np.random.default_rng(6)

    def text(letters, count=150):
        words = ["".join(chance.choice(list(letters), 3)) for _ in range(40)]
        return lambda: " ".join(chance.choice(words, count))

    one, other = text("abcdefgh"), text("mnopqrst")
    texts = [say() for _ in range(60) for say in (one, other)] + ["漢字仮名交文" * 100]
    rows = [(number, say, lang_of(number) if number < 120 else None, None) for number, say in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")


@pytest.mark.parametrize("lang_of,kept", [
    (lambda n: "ab"[n % 2], 120), (lambda n: ("en", "EN", "en-GB", "en_US")[n // 2 % 4] if n % 2 else "b", 120), (lambda n: None, 121)])
def test_language_stage_keeps_spellings_and_drops_what_fits_none(spark, lang_of, kept):
    found = corpus_pipeline.language(spark, spoken(spark, lang_of), "")
    assert sorted(row["doc_id"] for row in found.collect()) == list(range(kept))


def test_pipeline_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = "the quick brown fox jumps over the lazy dog and then it sleeps"
    rows = docs(spark, (1, plain), (2, None), (2, ""), (None, plain), (3, "123 456"), (4, plain + " " + "x" * 100_000), (1, plain))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(row["doc_id"] == 1 for row in found) <= 1
    rows.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []
