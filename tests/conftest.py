import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from casewatch.session import checkpoint_root, local_session
    s = local_session(cores="*", shuffle_partitions=8, app="casewatch-tests")
    checkpoint_root(s)  # uses spark.checkpoint.dir when set, else a fresh temp folder
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
