import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session
    s = get_session("local[*]", 8, "tidemark-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE


def rows(df, *cols):
    """Collect selected columns as a list of tuples (ordered as returned)."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
