"""CSV and JDBC outputs, and the staging table.

Staging remembers which file each row came from. A load writes a folder of its own, partitioned by date,
with the file as a column, and notes beside it which files it holds. One entry in a log of commits then
makes it visible: an entry lists all visible loads, so a reader looks at the last one only and lists no
folder beyond them. Of the loads that hold a file the newest counts, whatever other files it holds.

Staging folds itself. A load whose files have all been loaded again leaves the list at once. Whenever
``FAN_IN`` loads of one level have come together, their current rows are rewritten as one load of the
next level, so a row is rewritten a logarithmic number of times and small files are packed together.
Loads above ``SETTLED_BYTES`` are left alone until half of their files have been loaded again. Readers
join with the list of superseded files only for loads that have some. Folders that have left the list
are deleted ``KEEP_HOURS`` later, when no reader uses them any more.

Lines that gave no record are kept with the rows of their load, with the reason, and are seen and
superseded like them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.schema import REJECTED, STAGING, columns
from viewlog.sinks.commits import CommitLog, Taken

FAN_IN = 16  # loads of one level that are merged
SETTLED_BYTES = 64 << 30  # from this size on a load is not merged with others
KEEP_HOURS = 24.0  # that the folders of superseded loads stay
ABANDONED_HOURS = 7 * 24  # after which the folders of loads that were never listed go
BROADCAST_FILES = 100_000  # superseded (load, file) pairs, of about 100 bytes, that are broadcast

ROWS, DEAD = "rows", "rejected"  # the two parts of a load
HELD = columns(file="string", EventDate="date", load="string")
_LINE = ("SourceFile", "Line", "Reason")
STORED = T.StructType([*STAGING.fields, *columns(
    file="string", **{name: "string" for name in _LINE}, load="string", part="string").fields])


@dataclass(frozen=True)
class Load:
    """A visible load. ``stale`` of its ``files`` are held by a load of higher rank as well."""

    name: str
    rank: int
    level: int
    bytes: int
    files: int
    stale: int = 0


def write_csv(result: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` writes through one task: for small results only."""
    out = result.repartition(1) if single_file else result  # only the finished rows meet in one task
    out.write.mode(mode).option("header", "true").csv(path)


def write_jdbc(result: DataFrame, url: str, table: str, mode: str = "overwrite", **options: str) -> None:
    """Write to a database table; ``options`` are Spark's JDBC options (driver, user, ...)."""
    result.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def _file_key(path: Column) -> Column:
    """A short name for a file. Spark writes a path with one slash after the scheme, or with three."""
    return F.md5(F.regexp_replace(path, "^([a-z][a-z0-9+.-]*):/+", "$1:/"))


def append_staging(
    staging: DataFrame, root: str, load: str, mixed_dates: bool = False, files: Sequence[str] | None = None,
    checked: bool = False, fan_in: int = FAN_IN, keep_hours: float = KEEP_HOURS,
) -> None:
    """Add rows to staging, partitioned by date.

    Rows come from the file in their ``SourceFile`` column, or, without that column, count as one
    file named after the load. What staging held of these files before is replaced, once the new rows
    are complete; a load that fails changes nothing, and a repeated one adds no rows twice. ``files``
    names further files that were read but may have no usable row left. Rows with a ``Reason`` are
    lines without a record and become rejected lines. An empty frame is refused; ``checked`` says that
    the caller has looked.

    Landing files hold one day each, so a task meets few dates and rows are written where they were
    read, without a shuffle. ``mixed_dates`` gathers the rows of a date first, for sources where
    every task would otherwise write a small file for every date. Several writers may work at once; of
    two that load the same file, the later to finish holds it.
    """
    if not checked and staging.isEmpty():
        raise ValueError("nothing to load into staging")
    spark, has = staging.sparkSession, set(staging.columns)
    name = F.col("SourceFile") if "SourceFile" in has else F.lit(load)
    reason = F.col("Reason") if "Reason" in has else F.lit(None).cast("string")
    line = F.col("Line") if "Line" in has else F.lit(None).cast("string")
    dead = reason.isNotNull()
    shaped = staging.select(
        *STAGING.names, _file_key(name).alias("file"), F.when(dead, name).alias("SourceFile"), line.alias("Line"),
        reason.alias("Reason"), F.when(dead, DEAD).otherwise(ROWS).alias("part"))
    folder = f"{load}-{uuid.uuid4().hex}"
    held = _write_load(shaped, root, folder, gathered=mixed_dates).select("file", "EventDate").distinct()
    if files:
        named = spark.createDataFrame([(one,) for one in files], "name string")
        empty = named.select(_file_key(F.col("name")).alias("file")).join(held.select("file"), "file", "left_anti")
        held = held.unionByName(empty.distinct(), allowMissingColumns=True)
    count = _write_held(held, root, folder)
    size, log = _bytes(spark, f"{root}/load={folder}"), _log(spark, root)
    while True:
        number, loads, gone = _state(log)
        lost = _lost(spark, root, loads, folder)
        marked = [replace(one, stale=one.stale + lost.get(one.name, 0)) for one in loads]
        new = Load(folder, number + 1, 0, size, count)
        try:
            _commit(spark, root, log, number, gone, loads, [*marked, new], keep_hours)
            break
        except Taken:
            continue
    merge_staging(spark, root, fan_in, keep_hours=keep_hours)


def merge_staging(
    spark: SparkSession, root: str, fan_in: int = FAN_IN, settled: int = SETTLED_BYTES,
    keep_hours: float = KEEP_HOURS,
) -> int:
    """Merge loads while there are some to merge; returns how often. Content stays the same.

    A merge that another writer was faster with is given up. Rows loaded meanwhile stay newer than the
    merged ones, which keep the rank of the loads they come from.
    """
    log, merges = _log(spark, root), 0
    while chosen := _to_merge((loads := _state(log)[1]), fan_in, settled):
        folder, names = f"merged-{uuid.uuid4().hex}", {one.name for one in chosen}
        rows = _without_superseded(spark, root, _scan(spark, root, chosen), loads, chosen)
        _write_load(rows.select(*(name for name in STORED.names if name != "load")), root, folder, gathered=True)
        held = _without_superseded(spark, root, _held(spark, root, chosen), loads, chosen)
        count = _write_held(held.select("file", "EventDate"), root, folder)
        level = max(one.level for one in chosen) + (len(chosen) > 1)
        merged = Load(folder, max(one.rank for one in chosen), level, _bytes(spark, f"{root}/load={folder}"), count)
        while True:
            number, now, gone = _state(log)
            same = [one for one in now if one.name in names]
            if len(same) < len(chosen):
                _delete(spark, root, [folder])
                break
            since = sum(one.stale for one in same) - sum(one.stale for one in chosen)
            after = [*(one for one in now if one.name not in names), replace(merged, stale=since)]
            try:
                _commit(spark, root, log, number, gone, now, sorted(after, key=lambda one: one.rank), keep_hours)
                merges += 1
                break
            except Taken:
                continue
    if merges:
        _delete_abandoned(spark, root, log)
    return merges


def _to_merge(loads: list[Load], fan_in: int, settled: int) -> list[Load]:
    """Enough small loads of one level, else a large one of which half is superseded."""
    small = [one for one in loads if one.bytes < settled]
    for level in sorted({one.level for one in small}):
        same = [one for one in small if one.level == level]
        if len(same) >= max(2, fan_in):
            return same
    return [one for one in loads if one.bytes >= settled and 2 * one.stale >= one.files][:1]


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/_log")


def _state(log: CommitLog) -> tuple[int, list[Load], list[list]]:
    """Number of the last entry, the visible loads by rank, and what left the list with the time it did."""
    numbers = log.numbers()
    if not numbers:
        return 0, [], []
    entry = log.entry(numbers[-1])
    return numbers[-1], [Load(**one) for one in entry["loads"]], entry["gone"]


def _commit(
    spark: SparkSession, root: str, log: CommitLog, number: int, gone: list[list], before: list[Load],
    after: list[Load], keep_hours: float,
) -> None:
    """List ``after``, less what is wholly superseded; raises ``Taken`` if entry ``number`` is not the last any more."""
    now = int(time.time() * 1000)
    visible = [one for one in after if one.stale < one.files]
    names = {one.name for one in visible}
    gone = [*gone, *([one.name, now] for one in before if one.name not in names)]
    due = {name for name, since in gone if since <= now - keep_hours * 3_600_000}
    log.append(number + 1, {"loads": [asdict(one) for one in visible],
                            "gone": [one for one in gone if one[0] not in due]})
    _delete(spark, root, sorted(due))


def _write_load(shaped: DataFrame, root: str, folder: str, gathered: bool) -> DataFrame:
    """Write rows and rejected lines of a load in one pass, and read them back."""
    if gathered:
        shaped = shaped.hint("rebalance", F.col("part"), F.col("EventDate"))
    path = f"{root}/load={folder}"
    shaped.write.partitionBy("part", "EventDate").parquet(path)
    layout = T.StructType([field for field in STORED.fields if field.name != "load"])
    return shaped.sparkSession.read.schema(layout).parquet(path)


def _write_held(held: DataFrame, root: str, folder: str) -> int:
    """Write which files a load holds, with their dates; returns the number of files."""
    path = f"{root}/_files/load={folder}"
    held.write.parquet(path)
    layout = T.StructType([field for field in HELD.fields if field.name != "load"])
    return held.sparkSession.read.schema(layout).parquet(path).select("file").distinct().count()


def _read(spark: SparkSession, root: str, layout: T.StructType, loads: Sequence[Load]) -> DataFrame:
    """What loads have below a folder. Nothing but their own folders is listed."""
    if not loads:
        return spark.createDataFrame([], layout)
    paths = [f"{root}/load={one.name}" for one in loads]
    return spark.read.schema(layout).option("basePath", root).parquet(*paths).select(*layout.names)


def _scan(spark: SparkSession, root: str, loads: Sequence[Load]) -> DataFrame:
    return _read(spark, root, STORED, loads)


def _held(spark: SparkSession, root: str, loads: Sequence[Load]) -> DataFrame:
    return _read(spark, f"{root}/_files", HELD, loads)


def _ranked(spark: SparkSession, root: str, loads: Sequence[Load]) -> DataFrame:
    """The files of loads, with the load's rank. As many ranks as loads are listed are broadcast."""
    ranks = spark.createDataFrame([(one.name, one.rank) for one in loads], "load string, rank bigint")
    return _held(spark, root, loads).select("load", "file").distinct().join(F.broadcast(ranks), "load")


def _lost(spark: SparkSession, root: str, loads: list[Load], folder: str) -> dict[str, int]:
    """How many files each visible load loses to a new one: a row per load that loses any."""
    if not loads:
        return {}
    new = _held(spark, root, [Load(folder, 0, 0, 0, 0)]).select("file").distinct()
    holders = _ranked(spark, root, loads).join(new, "file", "left_semi")
    newest = holders.groupBy("file").agg(F.max_by("load", "rank").alias("load"))
    return {row["load"]: row["n"] for row in newest.groupBy("load").agg(F.count("*").alias("n")).collect()}


def _without_superseded(
    spark: SparkSession, root: str, rows: DataFrame, loads: list[Load], of: Sequence[Load]
) -> DataFrame:
    """Rows of the loads ``of``, by their ``load`` and ``file``, less those of files that a newer load holds."""
    stale = sum(one.stale for one in of)
    if not stale:
        return rows
    held = F.array_sort(F.collect_set(F.struct("rank", "load")))  # at most one per visible load
    by_file = _ranked(spark, root, loads).groupBy("file").agg(held.alias("held")).where(F.size("held") > 1)
    older = by_file.select("file", F.explode(F.expr("slice(held, 1, size(held) - 1)")).alias("old"))
    older = older.select("old.load", "file").where(F.col("load").isin([one.name for one in of if one.stale]))
    return rows.join(F.broadcast(older) if stale <= BROADCAST_FILES else older, ["load", "file"], "left_anti")


def _visible(spark: SparkSession, root: str, scan) -> DataFrame:
    """What ``scan`` reads of the visible loads; only loads with superseded files are joined with these."""
    _, loads, _ = _state(_log(spark, root))
    stale = [one for one in loads if one.stale]
    if not stale:
        return scan(spark, root, loads)
    current = _without_superseded(spark, root, scan(spark, root, stale), loads, stale)
    whole = [one for one in loads if not one.stale]
    return scan(spark, root, whole).unionByName(current) if whole else current


def read_staging(spark: SparkSession, root: str) -> DataFrame:
    """The current staging rows of all files; date filters prune partitions."""
    return _visible(spark, root, _scan).where(F.col("part") == ROWS).select(*STAGING.names)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the current loads of all files that gave no record, with the reason."""
    return _visible(spark, root, _scan).where(F.col("part") == DEAD).select(*REJECTED.names)


def dates_held(spark: SparkSession, root: str, files: DataFrame) -> list[date]:
    """The dates that staging holds of files, given by their paths in ``SourceFile``: one per calendar day at most."""
    known = files.select(_file_key(F.col("SourceFile")).alias("file")).distinct()
    found = _visible(spark, root, _held).join(known, "file", "left_semi")
    return [row["EventDate"] for row in found.select("EventDate").distinct().where("EventDate is not null").collect()]


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _bytes(spark: SparkSession, folder: str) -> int:
    path, system = _path(spark, folder)
    return system.getContentSummary(path).getLength()


def _delete(spark: SparkSession, root: str, loads: Sequence[str]) -> None:
    for name in loads:
        for folder in (f"{root}/load={name}", f"{root}/_files/load={name}"):
            path, system = _path(spark, folder)
            system.delete(path, True)


def _delete_abandoned(spark: SparkSession, root: str, log: CommitLog) -> None:
    """Folders of loads that failed before they were listed, once they are old."""
    path, system = _path(spark, root)
    old = (time.time() - ABANDONED_HOURS * 3600) * 1000
    found = [(entry.getPath().getName(), entry.getModificationTime()) for entry in system.listStatus(path)]
    _, loads, gone = _state(log)
    known = {one.name for one in loads} | {name for name, _ in gone}
    _delete(spark, root, [
        name[5:] for name, changed in found
        if name.startswith("load=") and name[5:] not in known and changed < old])


def append_staging_jdbc(staging: DataFrame, url: str, table: str, **options: str) -> None:
    """Append staging rows to a database table; an empty frame is refused."""
    if staging.isEmpty():
        raise ValueError("nothing to load into staging")
    write_jdbc(staging.select(*STAGING.names), url, table, mode="append", **options)
