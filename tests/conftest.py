from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from roundscope.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=4)
    yield session
    session.stop()


def collect(df, *order):
    """Rows as tuples, sorted with NULLs first."""
    rows = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


@pytest.fixture
def rows():
    return collect
