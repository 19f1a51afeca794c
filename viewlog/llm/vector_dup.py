"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Equal vectors are merged first. The rest are dealt to shards by a hash; each shard builds a graph of
layers, every layer the first sixteenth of the one below in a random order. Every vector then queries
every shard by beam search. A beam that is full of links is widened until it is not, and a sample of
queries is audited against all vectors of the shard: if the audit fails, the beam is widened for all.
Links are verified by cosine in double precision, and their components are the groups of copies.

A graph has a bounded number of bytes and lies in the shared folder, as files of plain arrays that
workers map into memory. Only its place travels: a task gets the numbers of a slice of vectors and of
the graphs to ask, so neither graphs nor vectors are shuffled once per question.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlog.llm.components import components
from viewlog.llm.hash_arrays import copied_files, file_system
from viewlog.llm.tables import delete, discard, stored
from viewlog.session import scratch_path

COSINE = 0.95
SHARDS = 8  # graphs of a small table; larger ones get as many as the two bounds below ask for
SHARD_ROWS, SHARD_BYTES = 100_000, 1 << 25  # vectors in one graph, and bytes of them in single precision
SLICE_ROWS, SLICE_BYTES = 16_384, 1 << 25  # queries one task asks one shard, and bytes of them in double precision
SEARCHES, MOST_TASKS = 4_096, 10_000  # queries of one graph that are worth a task; tasks at most
DEGREE = 16  # neighbours per vector; twice as many at the bottom
LAYER = 16  # a layer holds this share of the one below
BUILD_BEAM, FIRST_BEAM = 48, 32
WIDEST = 256  # a beam this wide takes longer than comparing with all of the shard
BATCH, BATCH_NUMBERS = 512, 1 << 17  # vectors inserted or searched together, and numbers in them
BLOCK = 4_096  # vectors, or pairs of them, compared in double precision at once
AUDITED, RECALL = 64, 0.98  # queries with links compared with brute force, and how many must find all theirs
SLACK = 1e-5  # single-precision error of a cosine


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _directions(vectors: np.ndarray, kind: type) -> np.ndarray:
    """Unit vectors of the rows; nothing but the result is as large as they are."""
    out = np.empty(vectors.shape, kind)
    for low in range(0, len(vectors), BLOCK):
        out[low:low + BLOCK] = _unit(vectors[low:low + BLOCK].astype(np.float64))
    return out


def _batch(size: int) -> int:
    """Vectors of so many components that are inserted or searched together."""
    return max(8, min(BATCH, BATCH_NUMBERS // max(1, size)))


def _layer_sizes(count: int) -> list[int]:
    """Nodes per layer, from the bottom."""
    sizes = [count]
    while sizes[-1] > LAYER:
        sizes.append(-(-sizes[-1] // LAYER))
    return sizes


class Graph:
    """Layered small-world graph over unit vectors; node n is row n, layers are prefixes of the rows."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = np.asarray(vectors, dtype=np.float32)
        self.sizes = _layer_sizes(len(vectors))
        self.layers: list[np.ndarray] = [None] * len(self.sizes)
        for level in range(len(self.sizes) - 1, -1, -1):
            self._build(level)

    # --- search ---

    def search(self, queries: np.ndarray, beam: int, bottom: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities of the best found per query, from layer to layer; -1 fills up."""
        top = len(self.sizes) - 1
        entry = np.zeros((len(queries), 1), dtype=np.int32)
        for level in range(top, bottom, -1):
            if self.layers[level] is not None:
                entry = self._beam(queries, entry, level, 4)[0]
        return self._beam(queries, entry, bottom, beam)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of one layer for all queries at once, one expansion each per step."""
        edges, count = self.layers[level], len(queries)
        nodes = np.full((count, beam), -1, dtype=np.int32)
        near = np.full((count, beam), -np.inf, dtype=np.float32)
        done = np.ones((count, beam), dtype=bool)
        width = min(beam, entry.shape[1])
        nodes[:, :width] = entry[:, :width]
        known = nodes[:, :width] >= 0
        near[:, :width] = np.where(known, self._similar(queries, nodes[:, :width]), -np.inf)
        done[:, :width] = ~known
        rows = np.arange(count)
        while len(rows):
            open_near = np.where(done[rows], -np.inf, near[rows])
            at = open_near.argmax(axis=1)
            active = open_near[np.arange(len(rows)), at] > -np.inf
            rows, at = rows[active], at[active]
            if not len(rows):
                break
            done[rows, at] = True
            beside = edges[nodes[rows, at]]
            own = nodes[rows]
            fresh = (beside >= 0) & ~(beside[:, :, None] == own[:, None, :]).any(axis=2)
            similar = self._similar(queries[rows], beside)
            # Only what beats the beam's worst may enter, so nothing comes back and the search ends.
            fresh &= similar > near[rows].min(axis=1)[:, None]
            similar[~fresh] = -np.inf
            if fresh.any():
                all_near = np.concatenate([near[rows], similar], axis=1)
                all_nodes = np.concatenate([own, beside], axis=1)
                all_done = np.concatenate([done[rows], ~fresh], axis=1)
                best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
                line = np.arange(len(rows))[:, None]
                near[rows], nodes[rows], done[rows] = all_near[line, best], all_nodes[line, best], all_done[line, best]
        nodes[near == -np.inf] = -1
        return nodes, near

    def _similar(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return np.einsum("qnd,qd->qn", self.vectors[nodes], queries)

    # --- construction ---

    def _build(self, level: int) -> None:
        """Insert the layer's nodes in batches; each links to what is nearest and not behind another."""
        size, degree = self.sizes[level], DEGREE * (2 if level == 0 else 1)
        above = self.sizes[level + 1] if level + 1 < len(self.sizes) else 0
        self.layers[level] = np.full((size, degree), -1, dtype=np.int32)
        close = np.full((size, degree), -np.inf, dtype=np.float32)
        start, batch = 0, _batch(self.vectors.shape[1])
        while start < size:
            stop = min(size, max(start + batch, above) if start == 0 else start + batch)
            for low in range(start, stop, batch):
                self._insert(level, close, np.arange(low, min(stop, low + batch)), start, stop)
            start = stop

    def _insert(self, level: int, close: np.ndarray, new: np.ndarray, start: int, stop: int) -> None:
        """Link ``new`` to nodes already searchable, those before ``start``, and to their own batch."""
        queries = self.vectors[new]
        fellow = queries @ self.vectors[start:stop].T
        fellow[np.arange(len(new)), new - start] = -np.inf
        width = min(BUILD_BEAM, stop - start)
        order = np.argpartition(-fellow, width - 1, axis=1)[:, :width]
        nodes = (order + start).astype(np.int32)
        near = np.take_along_axis(fellow, order, axis=1)
        if start:
            found, similar = self.search(queries, BUILD_BEAM, level)
            nodes, near = np.concatenate([nodes, found], axis=1), np.concatenate([near, similar], axis=1)
        best = np.argsort(-near, axis=1, kind="stable")[:, :BUILD_BEAM]
        nodes, near = np.take_along_axis(nodes, best, axis=1), np.take_along_axis(near, best, axis=1)
        chosen = self._diverse(nodes, near)
        at, column = np.nonzero(chosen)
        source, target, value = new[at], nodes[at, column], near[at, column]
        self._connect(level, close, np.concatenate([source, target]), np.concatenate([target, source]), np.concatenate([value, value]))

    def _diverse(self, nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Up to ``DEGREE`` per row, nearest first, each nearer to the row than to one chosen before."""
        vectors = self.vectors[nodes]
        between = vectors @ vectors.transpose(0, 2, 1)
        chosen = np.zeros(nodes.shape, dtype=bool)
        for place in range(nodes.shape[1]):
            behind = np.where(chosen, between[:, place, :], -np.inf).max(axis=1) > near[:, place]
            chosen[:, place] = (near[:, place] > -np.inf) & ~behind & (chosen.sum(axis=1) < DEGREE)
        # What room is left goes to the nearest of the others.
        spare = np.cumsum((near > -np.inf) & ~chosen, axis=1) <= (DEGREE - chosen.sum(axis=1))[:, None]
        return chosen | ((near > -np.inf) & spare)

    def _connect(self, level: int, close: np.ndarray, source: np.ndarray, target: np.ndarray, value: np.ndarray) -> None:
        """Add edges; a full node gives up the least similar neighbour that lies behind another."""
        edges = self.layers[level]
        order = np.lexsort((target, -value, source))
        source, target, value = source[order], target[order].astype(np.int32), value[order]
        turn = np.arange(len(source)) - np.searchsorted(source, source)
        for number in range(int(turn.max(initial=-1)) + 1):
            mine = turn == number
            at, to, similar = source[mine], target[mine], value[mine]
            new = ~(edges[at] == to[:, None]).any(axis=1)
            at, to, similar = at[new], to[new], similar[new]
            place = close[at].argmin(axis=1)
            full = np.flatnonzero(edges[at, place] >= 0)
            batch = _batch(self.vectors.shape[1])
            for low in range(0, len(full), batch):
                some = full[low:low + batch]
                place[some] = self._spare(
                    np.column_stack([edges[at[some]], to[some]]), np.column_stack([close[at[some]], similar[some]]))
            kept = place < edges.shape[1]  # else it is the new one that is given up
            at, place = at[kept], place[kept]
            edges[at, place], close[at, place] = to[kept], similar[kept]

    def _spare(self, nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
        """The column to give up: the least similar of those nearer to a nearer one, else of all.

        A node that leads out of a tight group is nearest to one member at least, which keeps it.
        """
        vectors = self.vectors[nodes]
        between = np.where(near[:, None, :] > near[:, :, None], vectors @ vectors.transpose(0, 2, 1), -np.inf)
        behind = between.max(axis=2) > near
        return np.where(behind | ~behind.any(axis=1, keepdims=True), near, np.inf).argmin(axis=1)


class Groups:
    """Disjoint sets over numbers, merged by arrays of pairs."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, items: np.ndarray) -> np.ndarray:
        found = self.parent[items]
        while not np.array_equal(up := self.parent[found], found):
            found = up
        self.parent[items] = found
        return found

    def merge(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            left, right = self.roots(left), self.roots(right)
            apart = left != right
            left, right = left[apart], right[apart]
            np.minimum.at(self.parent, np.maximum(left, right), np.minimum(left, right))


def _links(graph: Graph, exact: np.ndarray, queries: np.ndarray, cosine: float, start_beam: int):
    """Batches of (query rows, nodes): every pair found whose cosine is high enough."""
    beam, size, batch = start_beam, len(exact), _batch(queries.shape[1])
    for low in range(0, len(queries), batch):
        waiting, width = np.arange(low, min(low + batch, len(queries))), beam
        while len(waiting):
            if width >= min(size, WIDEST):  # compare with all of the shard
                for first in range(0, size, BLOCK):
                    row, node = np.nonzero(queries[waiting] @ exact[first:first + BLOCK].T >= cosine)
                    yield waiting[row], node + first
                break
            nodes, near = graph.search(queries[waiting].astype(np.float32), width)
            full = (near >= cosine - SLACK).all(axis=1)
            row, place = np.nonzero((near >= cosine - SLACK) & ~full[:, None])
            row, node = waiting[row], nodes[row, place]
            for first in range(0, len(row), BLOCK):
                some, others = row[first:first + BLOCK], node[first:first + BLOCK]
                linked = (queries[some] * exact[others]).sum(axis=1) >= cosine
                yield some[linked], others[linked]
            waiting, width = waiting[full], width * 2


def _audit(graph: Graph, exact: np.ndarray, queries: np.ndarray, cosine: float, own: np.ndarray) -> int:
    """The narrowest beam, doubling, that finds all links of enough queries of a sample.

    ``own`` is the node that a query itself is, -1 for none; it is no link. Queries count alike, however
    many links they have, and only those with links count: queries are compared with brute force until
    ``AUDITED`` have some, all of them if need be.
    """
    order, sample, true = np.random.default_rng(len(queries)).permutation(len(queries)), [], []
    for first in range(0, len(order), AUDITED):
        some = order[first:first + AUDITED]
        links = np.zeros(len(some), dtype=np.int64)
        for low in range(0, len(exact), BLOCK):
            # Rounding may decide otherwise for what is this close to the limit.
            linked = queries[some] @ exact[low:low + BLOCK].T >= cosine + 1e-12
            at = np.flatnonzero((own[some] >= low) & (own[some] < low + linked.shape[1]))
            linked[at, own[some[at]] - low] = False
            links += linked.sum(axis=1)
        sample.append(some[links > 0])
        true.append(links[links > 0])
        if sum(map(len, sample)) >= AUDITED:
            break
    sample, true = np.concatenate(sample or [order]), np.concatenate(true or [order])
    beam = FIRST_BEAM
    while beam < min(len(exact), WIDEST):
        found = np.zeros(len(sample), dtype=np.int64)
        for row, node in _links(graph, exact, queries[sample], cosine, beam):
            found += np.bincount(row[node != own[sample[row]]], minlength=len(sample))
        if (found >= true).sum() >= RECALL * len(sample):
            break
        beam *= 2
    return beam


@dataclass(frozen=True)
class Graphs:
    """Where the graphs of a run lie; small enough to travel with every task.

    Tasks write an array under a name of their own that is renamed when it is complete: a repeated or
    doubled task replaces files by equal ones.
    """

    folder: str
    copied: bool = False  # every executor has copies, as the folder is none that it can open

    def _name(self, size: int, shard: int, what: str) -> str:
        return f"{os.path.basename(self.folder)}-{size}.{shard}-{what}.npy"

    def put(self, size: int, shard: int, what: str, array: np.ndarray) -> None:
        files, folder = file_system(self.folder)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(begun := f"{folder}/_{uuid.uuid4().hex}") as out:
            np.save(out, array)
        files.move(begun, f"{folder}/{self._name(size, shard, what)}")

    def get(self, size: int, shard: int, what: str) -> np.ndarray:
        name = self._name(size, shard, what)
        return np.load(SparkFiles.get(name) if self.copied else f"{file_system(self.folder)[1]}/{name}", mmap_mode="r")

    def published(self, spark: SparkSession) -> Graphs:
        """The graphs, once all are written, in a form that every worker can open."""
        return Graphs(self.folder, copied_files(spark, self.folder, os.path.basename(self.folder)))


BUILT, FOUND = "size int, shard int, rows bigint", "left bigint, right bigint, links bigint"


def _build(batches: Iterator[pa.RecordBatch], graphs: Graphs) -> Iterator[pa.RecordBatch]:
    """Write the graph of every shard of a partition whose rows come shard by shard; one is held at a time."""
    held, parts = None, []

    def end() -> Iterator[pa.RecordBatch]:
        if parts:
            rows = _write(graphs, *held, *(np.concatenate([part.pop() for part in parts]) for _ in range(3)))
            yield pa.RecordBatch.from_pylist([{"size": held[0], "shard": held[1], "rows": rows}], pa.schema(
                [("size", pa.int32()), ("shard", pa.int32()), ("rows", pa.int64())]))
            parts.clear()

    for batch in batches:
        sizes, shards = batch.column("size").to_numpy(), batch.column("shard").to_numpy()
        edges = np.flatnonzero(np.diff(sizes, prepend=-1) | np.diff(shards, prepend=-1))
        for first, last in zip(edges, [*edges[1:], len(sizes)]):
            if held != (here := (int(sizes[first]), int(shards[first]))):
                yield from end()
                held = here
            some = batch.slice(first, last - first)
            vectors = some.column("vector").flatten().to_numpy().reshape(-1, here[0])
            # Copies, since views would hold on to whole batches; taken from the end.
            parts.append([vectors.copy(), some.column("copies").to_numpy().copy(), some.column("node").to_numpy().copy()])
    yield from end()


def _write(graphs: Graphs, size: int, shard: int, node: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> int:
    """Build and write one shard's graph, in an order drawn at random, with what is needed to verify links."""
    order = np.random.default_rng(len(node)).permutation(len(node))
    for what, array in ("node", node), ("copies", copies), ("vector", vectors):
        graphs.put(size, shard, what, array[order])
    exact = _directions(vectors, np.float32)[order]
    del vectors, array
    for level, edges in enumerate(Graph(exact).layers):
        graphs.put(size, shard, f"layer{level}", edges)
    return len(node)


def _ask(slices: Iterator[pd.DataFrame], graphs: Graphs, cosine: float) -> Iterator[pd.DataFrame]:
    """What slices of the vectors of shards find in others. A graph is read once for slices that ask it in turn."""
    held = None
    for rows in slices:
        for size, asker, first, last, shard in rows[["size", "asker", "first", "last", "shard"]].itertuples(index=False):
            if held != (size, shard):
                held, graph, exact = None, None, None  # before the next is read
                exact = _directions(graphs.get(size, shard, "vector"), np.float64)
                graph = Graph.__new__(Graph)
                graph.vectors, graph.sizes = exact.astype(np.float32), _layer_sizes(len(exact))
                graph.layers = [np.array(graphs.get(size, shard, f"layer{level}")) for level in range(len(graph.sizes))]
                ids, copies = (np.array(graphs.get(size, shard, what)) for what in ("node", "copies"))
                held = size, shard
            asked = np.array(graphs.get(size, asker, "node")[first:last])
            queries = _directions(graphs.get(size, asker, "vector")[first:last], np.float64)
            yield _query(asked, queries, graph, exact, ids, copies, cosine)


def _query(
    asked: np.ndarray, queries: np.ndarray, graph: Graph, exact: np.ndarray, ids: np.ndarray, copies: np.ndarray, cosine: float,
) -> pd.DataFrame:
    """What a slice of queries finds in one shard: per query the number of links, and links that join.

    Links inside a large group would be as many as its square. They are merged here, and one link
    per document and group goes out.
    """
    names, place = np.unique(np.concatenate([asked, ids]), return_inverse=True)
    groups, counts = Groups(len(names)), np.zeros(len(asked), dtype=np.int64)
    order = np.argsort(ids)
    at = order[np.minimum(np.searchsorted(ids, asked, sorter=order), len(ids) - 1)]
    own = np.where(ids[at] == asked, at, -1)
    for row, node in _links(graph, exact, queries, cosine, _audit(graph, exact, queries, cosine, own)):
        other = asked[row] != ids[node]
        row, node = row[other], node[other]
        counts += np.bincount(row, weights=copies[node], minlength=len(asked)).astype(np.int64)
        groups.merge(place[row], place[len(asked) + node])
    roots = groups.roots(np.arange(len(names)))
    moved = np.flatnonzero(roots != np.arange(len(names)))
    some = np.flatnonzero(counts)
    return pd.DataFrame({
        "left": np.concatenate([names[moved], asked[some]]), "right": np.concatenate([names[roots[moved]], asked[some]]),
        "links": np.concatenate([np.zeros(len(moved), np.int64), counts[some]])})


def _usable(vector: Column) -> Column:
    """Neither NULL nor empty nor zero, and all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _found(classes: DataFrame, cosine: float, shards: int, slice_rows: int) -> DataFrame:
    """What all vectors find in all shards of their size; deletes the classes, which are not needed any more."""
    spark = classes.sparkSession
    per_size = stored(classes.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("rows")).select("size", F.greatest(
        F.lit(shards), F.ceil(F.col("rows") / SHARD_ROWS), F.ceil(F.col("rows") * F.col("size") * 4 / SHARD_BYTES)).cast("int").alias("shards"),
    ), "vector-sizes")
    most = per_size.agg(F.max("shards")).first()[0] or 1
    dealt = (
        classes.withColumn("size", F.size("vector")).join(F.broadcast(per_size), "size")
        .withColumn("shard", F.pmod(F.xxhash64("key"), "shards").cast("int"))
        .repartitionById(most, "shard").sortWithinPartitions("size", "shard", "node", "key"))
    graphs = Graphs(scratch_path(spark, "llm/vector-graphs"))
    built = stored(dealt.select("size", "shard", "node", "copies", "vector").mapInArrow(
        lambda batches: _build(batches, graphs), BUILT), "graphs")
    discard(classes)

    step = F.least(F.lit(slice_rows), F.greatest(F.lit(1), F.floor(F.lit(SLICE_BYTES) / (8 * F.col("size"))))).cast("bigint")
    slices = built.withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1, step))).select(
        "size", F.col("shard").alias("asker"), "first", F.least("rows", F.col("first") + step).alias("last"))
    asks = slices.join(F.broadcast(built.select("size", "shard")), "size")
    many, searches = asks.agg(F.count("*"), F.coalesce(F.sum(F.col("last") - F.col("first")), F.lit(0))).first()
    tasks = max(1, min(many, -(-searches // SEARCHES), MOST_TASKS))
    published = graphs.published(spark)
    found = stored(asks.repartition(tasks).sortWithinPartitions("size", "shard").mapInPandas(
        lambda rows: _ask(rows, published, cosine), FOUND), "vector-links")
    delete(spark, graphs.folder)
    return found


def near_duplicates(
    vectors: DataFrame, column: str = "embedding", cosine: float = COSINE, shards: int = SHARDS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows whose cosine with this one was found to be high enough, equal
    vectors among them; ``component_id`` is the smallest id that links lead to; ``kept`` is true for
    that row. What is found is verified in double precision, so no link is below the limit. A search
    may miss links: per slice and shard, audits require that 0.98 of a sample of queries find all theirs.

    A vector that is NULL, empty or zero, or has a NULL or non-finite component, has no links, and so
    has one whose id is NULL. Vectors of different length are not compared. Rows that share an id
    count as one vector with several values. Other columns are ignored; no rows give no rows.
    """
    # One type before anything else: equal values are equal vectors. Single precision stays as it is, at half the bytes.
    kind = "array<float>" if vectors.select(vectors[column]).dtypes[0][1] == "array<float>" else "array<double>"
    rows = vectors.select(vectors["vec_id"].cast("bigint").alias("vec_id"), vectors[column].cast(kind).alias("vector"))
    usable = F.col("vec_id").isNotNull() & _usable(F.col("vector"))
    # Two hashes make one key of 128 bits for the whole vector.
    keyed = rows.withColumn("usable", usable).withColumn("key", F.when(F.col("usable"), F.struct(
        F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), F.col("vector")).alias("b"))))
    usable_rows = keyed.where("usable")
    classes = stored(usable_rows.groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "vector-classes")
    members = stored(usable_rows.select("vec_id", "key").join(classes.select("key", "node", "copies"), "key").drop("key"), "vector-members")

    found = _found(classes, cosine, shards, slice_rows)

    several = stored(members.groupBy("vec_id").agg(F.min("node").alias("left"), F.max("node").alias("right")).where(
        F.col("left") < F.col("right")), "several-vectors")
    same_id = members.join(several, "vec_id").select("left", F.col("node").alias("right"))
    labels = components(found.where("left != right").select("left", "right").unionByName(same_id), "left", "right")
    counts = stored(found.where("links > 0").groupBy(F.col("left").alias("node")).agg(F.sum("links").alias("links")), "link-counts")
    linked = (
        members.join(counts, "node", "left")
        .join(labels.select(F.col("node"), F.col("component")), "node", "left")
        .select(
            "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id")))
    alone = keyed.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
