"""Session settings the jobs rely on, and the shared folder they write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Adaptive execution sizes and splits the shuffle partitions at run time; the time zone is pinned
# because results depend on it; without the call-site capture plans are built faster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "viewlog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` uses ``__`` for the dots of a setting name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {name.replace("__", "."): str(value) for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def together(spark: SparkSession, *works: Callable[[], object]) -> None:
    """Do works that need nothing of each other side by side, so that one fills the cores another leaves idle.

    All have ended when this returns; if any failed, the first error is raised.
    """
    with ThreadPoolExecutor(len(works)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
    for work in begun:
        work.result()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors are one machine, may fall back to a
    temporary folder; on a cluster an unset folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="viewlog-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path inside the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/viewlog/{name}-{uuid.uuid4().hex}"
