import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martline.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="martline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
