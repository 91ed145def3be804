"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from signalweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate Columns over one row with the given text; a single Column gives its value."""

    def run(text, *columns):
        row = spark.createDataFrame([(text,)], "text STRING").select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return run
