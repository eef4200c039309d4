import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))

    return collect
