import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridemart.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="ridemart-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from ridemart.session import scratch_path
    return lambda name: scratch_path(spark, name)
