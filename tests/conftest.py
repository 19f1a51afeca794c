from __future__ import annotations

import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from viewlog import schema  # noqa: E402
from viewlog.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="3", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false", spark__default__parallelism="3")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="session")
def staged(spark):
    """Build a staging frame from (contract, mac, app, seconds, ISO day) rows."""

    def build(*rows):
        typed = [(*row[:4], day(row[4]) if row[4] else None) for row in rows]
        return spark.createDataFrame(typed, schema.STAGING)

    return build


def values(frame, *columns):
    """Rows as a sorted list of tuples; NULLs sort first."""
    rows = [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])
