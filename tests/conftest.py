import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from canonix.session import local_session

    s = local_session(4, shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="canonix-test-")


def rows(df, order=None):
    cols = df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
