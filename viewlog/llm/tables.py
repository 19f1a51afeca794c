"""Input columns and intermediate tables shared by the training-data operators."""

from __future__ import annotations

import functools
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import viewlog
from viewlog.session import scratch_path, shared_folder

WORD = r"[^\x20\x09-\x0D]+"  # a word is a run of anything but the six ASCII white-space characters
HELD_OUT_OF = 3  # documents with crc32(doc_id) mod 3 = 1 are never learned from


def importable(job):
    """The job, with Python workers importing this package from where the driver found it.

    That is for a driver that was started in another folder; a cluster has the package installed or
    gets it by ``--py-files`` as usual.
    """
    home = str(Path(viewlog.__file__).resolve().parent.parent)

    @functools.wraps(job)
    def run(spark, *args):
        variables = spark.sparkContext.environment
        known = variables.get("PYTHONPATH", "").split(os.pathsep)
        if home not in known:
            variables["PYTHONPATH"] = os.pathsep.join([home, *filter(None, known)])
        return job(spark, *args)

    return run


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    This cuts the lineage: a lost executor costs the files it was writing, never a finished table,
    and a later job does not compute the frame again.
    """
    path = scratch_path(frame.sparkSession, f"llm/{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the folder of a frame that ``stored`` gave and that no later job reads."""
    spark = frame.sparkSession
    kept = f"{shared_folder(spark)}/viewlog/llm/"
    for name in {os.path.dirname(file) for file in frame.inputFiles()}:
        if kept.removeprefix("file:").lstrip("/") in name:
            delete(spark, name)


def delete(spark: SparkSession, name: str) -> None:
    """Delete a folder of the shared folder; none is no error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(frame: DataFrame, column: str = "text") -> Column:
    """The column as a string, empty where it is NULL."""
    return F.coalesce(frame[column].cast("string"), F.lit(""))


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of all learning; a NULL id counts as held out."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % HELD_OUT_OF == 1, F.lit(True))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]
