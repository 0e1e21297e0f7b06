import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quarry.session import get_session  # noqa: E402

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="quarry-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_sf():
    if not os.path.isdir(SMALL_SF):
        pytest.skip("driver test data not present")
    return SMALL_SF
