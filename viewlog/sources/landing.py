"""Daily JSON-lines landing files.

Every reader passes the fixed schema, so Spark neither scans the files to infer one nor needs to
union per-file frames: a column that a file lacks is simply NULL. A malformed line becomes a row
whose ``_source`` is NULL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlog.functions.calendar import day_from_name
from viewlog.functions.measures import whole_seconds
from viewlog.schema import RAW

NOT_JSON, NO_RECORD = "not JSON", "no record"  # why a line is rejected


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """One landing file, or a folder of them."""
    return spark.read.schema(RAW).json(path)


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many landing files as one scan. A file that is missing or cannot be read to its end raises."""
    if not paths:
        raise ValueError("no landing file to read")
    return spark.read.schema(RAW).json(list(paths))


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many landing files as their lines, in the column ``value``; otherwise as ``read_files``."""
    if not paths:
        raise ValueError("no landing file to read")
    return spark.read.text(list(paths))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines as raw records; a line without one stays, as ``Line``, with the ``Reason``.

    Blank lines are passed over. A line may hold an array of records, as for ``read_files``; then the line
    stands with each of them that cannot be used. Values are those ``read_files`` gives, but for an object in
    the place of a text, which is written without blanks. Other columns of the lines are kept.
    """
    kept = [name for name in lines.columns if name != "value"]
    parsed = lines.where(F.col("value").rlike(r"\S")).withColumn("_records", F.from_json("value", T.ArrayType(RAW)))
    each = parsed.select("*", F.explode_outer("_records").alias("_record"))
    reason = F.when(F.col("_records").isNull(), NOT_JSON).when(F.col("_record._source").isNull(), NO_RECORD)
    return each.withColumn("Reason", reason).select(
        F.col("_record._source").alias("_source"), F.when(F.col("Reason").isNotNull(), F.col("value")).alias("Line"),
        "Reason", *kept)


def readable(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """The paths that can be read to their end, and those that cannot.

    A file is taken whole or not at all. All paths are read in one job, for the caller who would rather
    load without a broken file than not at all. A job that meets a broken or missing file ends and names
    it, and the others are read again without it: a job more for each such file, none for the rest. The
    first path has to be readable.
    """
    good, bad = list(paths), []
    while good:
        try:
            spark.read.text(good).agg(F.sum(F.length("value"))).collect()
            break
        except (PySparkException, Py4JJavaError) as error:  # not found, or broken on the way
            broken = _named_in(str(error), good) or _first_broken(spark, good)
            if broken is None or broken == paths[0]:
                raise
            good = [path for path in good if path != broken]
            bad.append(broken)
    return good, [path for path in paths if path in set(bad)]


def _named_in(message: str, paths: Sequence[str]) -> str | None:
    """The path that an error is about; the longest one where one begins another."""
    def named(path: str) -> bool:
        return re.search(re.escape(re.sub("^[a-z][a-z0-9+.-]*:/+", "/", path)) + r"(?![\w-])", message) is not None

    return max(filter(named, paths), key=len, default=None)


def _first_broken(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """Where an error names no path, such as for patterns: the first that fails by itself."""
    for path in paths:
        try:
            spark.read.text(path).agg(F.sum(F.length("value"))).collect()
        except (PySparkException, Py4JJavaError):
            return path
    return None


def read_folder(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Every ``*.json`` file of a folder, with ``recursive`` also those of its sub-folders."""
    reader = spark.read.schema(RAW).option("recursiveFileLookup", str(recursive).lower())
    try:
        return reader.json(folder, pathGlobFilter="*.json")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"landing folder does not exist: {folder}") from error
        raise


def paths_in_folder(spark: SparkSession, folder: str, recursive: bool = False) -> list[str]:
    """The files ``read_folder`` reads, in order."""
    return sorted(read_folder(spark, folder, recursive).inputFiles())


def paths_in_range(spark: SparkSession, folder: str, start: str, end: str) -> list[str]:
    """The files ``read_date_range`` reads, in order; none for a range without any."""
    return sorted(read_date_range(spark, folder, start, end).inputFiles())


def read_date_range(spark: SparkSession, folder: str, start: str, end: str) -> DataFrame:
    """Files named after the days ``start``..``end`` (``yyyyMMdd``, inclusive).

    One glob covers the range, so days without a file are passed over. A range without any file,
    such as a reversed one, gives an empty frame.
    """
    days = days_between(start, end)
    empty = spark.createDataFrame([], RAW)
    if not days:
        return empty
    try:
        return read_file(spark, f"{folder}/{{{','.join(days)}}}.json")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise


def days_between(start: str, end: str) -> list[str]:
    """Day texts from ``start`` to ``end``; malformed text raises ``ValueError``."""
    first, last = (datetime.strptime(text, "%Y%m%d") for text in (start, end))
    return [f"{first + timedelta(n):%Y%m%d}" for n in range((last - first).days + 1)]


def with_name_date(raw: DataFrame, level: str = "file", undated: str = "drop") -> DataFrame:
    """Add ``DateValue``, the ``yyyyMMdd`` in the file name.

    ``level="folder"`` takes it from the enclosing folder, the layout Spark writes daily files in.
    Rows of undated files are left out, or with ``undated="keep"`` have an empty value.
    """
    if level not in ("file", "folder"):
        raise ValueError(f"level must be 'file' or 'folder', not {level!r}")
    if undated not in ("drop", "keep"):
        raise ValueError(f"undated must be 'drop' or 'keep', not {undated!r}")
    name = (
        F.col("_metadata.file_name")
        if level == "file"
        else F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    )
    dated = raw.withColumn("DateValue", day_from_name(name))
    return dated if undated == "keep" else dated.where(F.col("DateValue") != "")


def with_source(raw: DataFrame, level: str = "file") -> DataFrame:
    """Add what a load keeps about a row's file: ``SourceFile``, its path, and ``DateValue``."""
    return with_name_date(raw.withColumn("SourceFile", F.col("_metadata.file_path")), level, undated="keep")


def line_counts() -> list[Column]:
    """Lines, lines that did not parse into a record, and durations that are no number."""
    seconds = F.col("_source.TotalDuration")
    return [
        F.count(F.lit(1)).alias("Lines"),
        F.count_if(F.col("_source").isNull()).alias("BadLines"),
        F.count_if(seconds.isNotNull() & whole_seconds(seconds).isNull()).alias("BadDurations"),
    ]


def bad_lines(raw: DataFrame) -> DataFrame:
    """``line_counts`` of raw lines as one row."""
    return raw.agg(*line_counts())
