import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cityzones.session import build_session
    # A checkpoint folder of our own only when the environment names none.
    default_dir = tempfile.mkdtemp(prefix="cityzones-ckpt-")
    s = build_session("local[4]", app="cityzones-tests", shuffle_partitions=8,
                      default_checkpoint_dir=default_dir)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir(spark):
    from cityzones.session import scratch_path
    return scratch_path(spark, "test")


def row_key(t):
    """Natural order (numbers numerically, other values as text), None last."""
    key = []
    for x in t:
        if x is None:
            key.append((1, 0, 0))
        elif isinstance(x, (int, float)):
            key.append((0, 0, x))
        else:
            key.append((0, 1, str(x)))
    return tuple(key)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=row_key)
