import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app="strata-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of a DataFrame (optionally some columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def srt(items):
    """Sort expected tuples the way :func:`rows` sorts results."""
    return sorted(items, key=lambda t: tuple((x is None, str(x)) for x in t))
