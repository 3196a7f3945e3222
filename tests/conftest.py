import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from silverlode.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, NULLs first."""

    def collect(df, *cols):
        out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(out, key=lambda r: [(v is not None, v) for v in r])

    return collect
