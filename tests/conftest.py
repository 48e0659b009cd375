import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridelake.session import build_session, release_staging  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ridelake-tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="4000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_staging(session)
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        names = columns or df.columns
        return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)

    return collect
