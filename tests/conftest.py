import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def many_buckets(monkeypatch):
    """Small buckets, so that running totals cross many of them."""
    from riskloom.operators import ordering

    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 7)
