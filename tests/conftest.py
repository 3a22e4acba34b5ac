import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))
