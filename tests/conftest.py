import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session, checkpoint_root

    s = build_session("local[*]", shuffle_partitions=8)
    checkpoint_root(s)  # registers a checkpoint dir only when the session has none
    yield s
    s.stop()
