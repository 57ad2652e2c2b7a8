import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pairscore.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, app_name="pairscore-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.exists(SF_SMALL):
        pytest.skip("test tables not present")
    return SF_SMALL
