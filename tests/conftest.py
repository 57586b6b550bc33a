import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_test_session
    s = local_test_session(cores=4, shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def store_root(spark):
    from tidemark.session import scratch_path
    return scratch_path(spark, "test-store")
