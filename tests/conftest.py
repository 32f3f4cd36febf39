import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build(master="local[*]", shuffle_partitions=8, app="kestrel-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="kestrel-test-", dir="/tmp")


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    return sorted(tuple(r) for r in df.collect())
