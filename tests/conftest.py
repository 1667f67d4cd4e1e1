from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions=4,
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(df)``: the rows as a sorted list of dicts."""

    def collect(df):
        found = [r.asDict() for r in df.collect()]
        return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r.values()])

    return collect
