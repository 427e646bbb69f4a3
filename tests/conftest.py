import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from catalink.session import build_session

    session = build_session("local[4]", app_name="catalink-tests", shuffle_partitions=8)
    yield session
    session.stop()
