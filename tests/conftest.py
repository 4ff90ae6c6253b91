from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millwright.workspace import open_session  # noqa: E402

TESTDATA = os.environ.get("MILLWRIGHT_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = open_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    return TESTDATA


def rows(df):
    """All rows as plain tuples in a stable order, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
