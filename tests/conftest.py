import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from arealoom.session import local_session

    session = local_session(cores=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
