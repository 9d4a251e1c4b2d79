import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from bursa.session import get_session
    s = get_session("local[4]", 4, app_name="bursa-tests")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
