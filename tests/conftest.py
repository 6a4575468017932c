import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("4")


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collected(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collected
