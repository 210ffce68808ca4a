import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from encore.session import get_session
    session = get_session("local[4]", app="encore-tests", shuffle_partitions=4)
    yield session
    session.stop()
