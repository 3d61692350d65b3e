import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from runlens.session import local_session
    session = local_session(8, "tests", "8g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is not None, str(type(x)), x) for x in t))
    return collect


@pytest.fixture(params=["broadcast", "salted"])
def join_way(request, monkeypatch):
    """Run a test with small sides broadcast and with them too large for it."""
    if request.param == "salted":
        from runlens.plans import tables
        monkeypatch.setattr(tables, "BROADCAST_ROWS", -1)
    return request.param
