import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from casestar.session import build_session
    s = build_session("local[*]", app="casestar-tests", shuffle_partitions=2, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.exists(f"{SMALL}/lineitem.parquet"):
        pytest.skip("driver test data not available")
    return SMALL
