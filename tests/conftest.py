import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
# Scale of the differential check (the driver's gate runs sf0.01).
SF_CHECK = os.environ.get("TIDEPOOL_CHECK_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import get_session
    s = get_session("tidepool-tests", master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tidepool.plans.verify import duckdb_connection
    return duckdb_connection(SF_SMALL)
