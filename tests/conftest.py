import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labelloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, 8, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
