import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from feedrec.session import build_session

    s = build_session("local[8]", shuffle_partitions=8)
    # tests pick their own checkpoint folder only because none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedrec-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
