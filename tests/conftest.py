import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mercantile.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (NULLs first) for order-free comparison."""
    cols = cols or tuple(df.columns)
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
