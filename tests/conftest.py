import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dimweave.session import build_session

    s = build_session("local[*]", 8, app_name="dimweave-tests")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
