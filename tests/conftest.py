import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyline.session import local_session  # noqa: E402

ROOT = os.environ.get("SKYLINE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, driver_memory="6g")


@pytest.fixture(scope="session")
def root():
    return ROOT


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(ROOT)


@pytest.fixture
def make(spark):
    """Frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
