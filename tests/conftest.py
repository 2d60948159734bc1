import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetcheck.session import local_session  # noqa: E402
from fleetcheck.tables import fleet_of  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "4g")


@pytest.fixture(scope="session")
def fleet(spark):
    return fleet_of(spark, SMALL)


@pytest.fixture
def rows(spark):
    """Make a DataFrame from tuples and a schema text."""
    return lambda data, schema: spark.createDataFrame(data, schema)
