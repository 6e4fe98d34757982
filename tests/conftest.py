import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    session = build_session(master="local[4]", shuffle_partitions=4, app_name="strata-tests")
    yield session
    session.stop()
