"""Tables of numbers by 64-bit hash, as sorted arrays in files that workers map into memory.

A table is cut into shards by the leading bits of the hash, so the shards in turn are one sorted array.
A shard is a file of hashes and one file per value column, all plain arrays. Tasks write them straight
into the shared folder, batch by batch, under a name of their own that is renamed when the shard is
complete: a repeated or doubled task replaces files by equal ones, and a lost one leaves nothing that is
read. Readers map the files, so the operating system keeps the pages that are used and may drop them.

The shared folder has to be one that the machines can open, or one that Spark can fetch files from:
then every executor gets its own copies by ``addFile``, since only local files can be mapped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

P1, P2, P3, P4, P5 = (np.uint64(prime) for prime in (  # fixed values of XXH64
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SEED = 42  # of the engine's own xxhash64
KINDS = {"bigint": np.int64, "float": np.float32}


def _turned(value: np.ndarray, bits: int) -> np.ndarray:
    return (value << np.uint64(bits)) | (value >> np.uint64(64 - bits))


def hash_numbers(columns: list[np.ndarray]) -> np.ndarray:
    """What the engine's ``xxhash64`` gives for columns of 64-bit numbers."""
    out = np.full(len(columns[0]), SEED, dtype=np.uint64)
    for column in columns:
        out = out + P5 + np.uint64(8)
        out ^= _turned(column.astype(np.int64).view(np.uint64) * P2, 31) * P1
        out = _turned(out, 27) * P1 + P4
        out ^= out >> np.uint64(33)
        out *= P2
        out ^= out >> np.uint64(29)
        out *= P3
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


@dataclass(frozen=True)
class HashTable:
    """Where a table lies; small enough to travel with every task."""

    folder: str
    name: str
    bits: int  # 2**bits shards
    columns: tuple[tuple[str, str], ...]  # name and type of the values
    copied: bool = False

    @property
    def kinds(self) -> dict[str, type]:
        return {"hash": np.int64} | {name: KINDS[kind] for name, kind in self.columns}

    @property
    def shards(self) -> int:
        return 1 << self.bits

    def shard(self, hashed: Column) -> Column:
        """The shard of a hash; shards in turn follow the order of hashes."""
        if not self.bits:
            return F.lit(0)
        return (F.shiftright(hashed, 64 - self.bits) + F.lit(self.shards // 2)).cast("int")

    def owner(self, hashes: np.ndarray) -> np.ndarray:
        """The shards of hashes."""
        if not self.bits:
            return np.zeros(len(hashes), dtype=np.int64)
        return (hashes >> np.int64(64 - self.bits)) + self.shards // 2

    def file(self, shard: int, column: str) -> str:
        return f"{self.name}-{shard}-{column}"


def table(folder: str, name: str, rows: int, per_shard: int, **columns: str) -> HashTable:
    """A table for about ``rows`` rows, in shards of about ``per_shard``."""
    return HashTable(folder, name, max(0, (-(-rows // per_shard) - 1).bit_length()), tuple(columns.items()))


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pa.fs.LocalFileSystem(), uri)


class _Shard:
    """The files of a shard that is being written."""

    def __init__(self, target: HashTable, number: int):
        self.target, self.number, self.token = target, number, uuid.uuid4().hex
        self.files, self.path = file_system(target.folder)
        self.files.create_dir(self.path, recursive=True)
        self.kinds = target.kinds
        self.streams = {name: self.files.open_output_stream(f"{self.path}/_{self.token}-{name}") for name in self.kinds}

    def append(self, **columns: np.ndarray) -> None:
        for name, kind in self.kinds.items():
            self.streams[name].write(np.ascontiguousarray(columns[name], dtype=kind).tobytes())

    def close(self) -> None:
        for name, stream in self.streams.items():
            stream.close()
            self.files.move(f"{self.path}/_{self.token}-{name}", f"{self.path}/{self.target.file(self.number, name)}")


class _Writer:
    """The shards of one task, written in ascending order of hashes."""

    def __init__(self, target: HashTable):
        self.target, self.shard = target, None

    def append(self, hashes: np.ndarray, **columns: np.ndarray) -> None:
        owner = self.target.owner(hashes)
        edges = [0, *np.flatnonzero(np.diff(owner)) + 1, len(hashes)]
        for first, last in zip(edges, edges[1:]):
            if first == last:
                continue
            if self.shard is None or self.shard.number != owner[first]:
                self.close()
                self.shard = _Shard(self.target, int(owner[first]))
            self.shard.append(hash=hashes[first:last], **{name: values[first:last] for name, values in columns.items()})

    def close(self) -> None:
        if self.shard is not None:
            self.shard.close()
        self.shard = None


def write(
    rows: DataFrame, target: HashTable, keys: list[str], reduce: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    layout: T.StructType,
) -> DataFrame:
    """A frame that, when it is run, adds up the ``count`` of rows of equal ``keys`` and writes the sums.

    Its rows are what ``reduce`` makes of the added rows, which it gets in batches of keys and count.
    Rows are dealt out by the shard of the hash of their keys and sorted by it, so equal ones meet side
    by side: there is one shuffle, and no shard is held in memory.
    """
    hashed = F.xxhash64(*keys)
    dealt = rows.repartition(target.shards, target.shard(hashed)).withColumn("_hash", hashed)
    dealt = dealt.sortWithinPartitions("_hash").select(*keys, "count")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, held = _Writer(target), None  # the last key may go on in the next batch
        for batch in batches:
            columns = [batch.column(name).to_numpy() for name in (*keys, "count")]
            if held is not None:
                columns = [np.concatenate([last, column]) for last, column in zip(held, columns)]
            if not len(columns[0]):
                continue
            hashes = hash_numbers(columns[:-1])
            first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
            sums = np.add.reduceat(columns[-1], first)
            held = [*(column[first[-1:]] for column in columns[:-1]), sums[-1:]]
            if len(first) > 1:
                done = first[:-1]
                writer.append(hashes[done], count=sums[:-1])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(column[done]) for column in columns[:-1]), pa.array(sums[:-1])], [*keys, "count"])
        if held is not None:
            writer.append(hash_numbers(held[:-1]), count=held[-1])
            yield pa.RecordBatch.from_arrays([*map(pa.array, held)], [*keys, "count"])
        writer.close()

    return dealt.mapInArrow(lambda batches: reduce(added(batches)), layout)


def store(rows: DataFrame, target: HashTable) -> None:
    """Write the table from rows of distinct ``hash`` and the table's value columns."""
    names = [name for name, _ in target.columns]
    dealt = rows.select("hash", *names).repartition(target.shards, target.shard(F.col("hash"))).sortWithinPartitions("hash")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(target)
        for batch in batches:
            writer.append(batch.column("hash").to_numpy(), **{name: batch.column(name).to_numpy() for name in names})
        writer.close()
        yield from ()

    dealt.mapInArrow(put, "done boolean").write.format("noop").mode("overwrite").save()


def published(spark: SparkSession, target: HashTable) -> HashTable:
    """The table, once all of it is written, in a form that every worker can open."""
    copied = copied_files(spark, target.folder, target.name)
    return HashTable(target.folder, target.name, target.bits, target.columns, copied=True) if copied else target


def copied_files(spark: SparkSession, folder: str, name: str) -> bool:
    """Whether workers cannot open the folder; then they get copies of its files whose names begin with ``name-``."""
    if urlparse(folder).scheme in ("", "file"):
        return False
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    for entry in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path):
        if entry.getPath().getName().startswith(f"{name}-"):
            spark.sparkContext.addFile(entry.getPath().toString())
    return True


class Reader:
    """A table mapped into memory, shard by shard as it is asked for."""

    _open: dict[HashTable, Reader] = {}

    @classmethod
    def of(cls, target: HashTable) -> Reader:
        """The reader of this worker process."""
        if target not in cls._open:
            cls._open[target] = cls(target)
        return cls._open[target]

    def __init__(self, target: HashTable):
        self.target = target
        self.kinds = target.kinds
        self.maps: dict[int, dict[str, np.ndarray]] = {}
        self._starts: np.ndarray | None = None

    def _path(self, shard: int, column: str) -> str:
        name = self.target.file(shard, column)
        return SparkFiles.get(name) if self.target.copied else f"{file_system(self.target.folder)[1]}/{name}"

    def _shard(self, number: int) -> dict[str, np.ndarray]:
        if number not in self.maps:
            paths = {name: self._path(number, name) for name in self.kinds}
            there = os.path.exists(paths["hash"]) and os.path.getsize(paths["hash"])
            self.maps[number] = {
                name: np.memmap(paths[name], kind, "r") if there else np.empty(0, kind) for name, kind in self.kinds.items()}
        return self.maps[number]

    @property
    def starts(self) -> np.ndarray:
        """How many entries lie before each shard."""
        if self._starts is None:
            paths = [self._path(number, "hash") for number in range(self.target.shards)]
            sizes = [os.path.getsize(path) // 8 if os.path.exists(path) else 0 for path in paths]
            self._starts = np.cumsum([0, *sizes])
        return self._starts

    def find(self, hashes: np.ndarray, *columns: str) -> tuple[np.ndarray, ...]:
        """Places of hashes in the whole sorted array, -1 where there is none, and their values, else 0.

        Each distinct hash is looked up once, in ascending order, so neighbours share pages.
        """
        asked, back = np.unique(hashes, return_inverse=True)
        place = np.full(len(asked), -1, dtype=np.int64)
        values = {name: np.zeros(len(asked), dtype=self.kinds[name]) for name in columns}
        owner = self.target.owner(asked)
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        for first, last in zip(edges, [*edges[1:], len(asked)]):
            number = int(owner[first])
            arrays = self._shard(number)
            if not len(arrays["hash"]):
                continue
            at = np.searchsorted(arrays["hash"], asked[first:last])
            at = np.minimum(at, len(arrays["hash"]) - 1)
            hit = np.flatnonzero(arrays["hash"][at] == asked[first:last])
            place[first + hit] = self.starts[number] + at[hit]
            for name in columns:
                values[name][first + hit] = arrays[name][at[hit]]
        return place[back], *(values[name][back] for name in columns)
