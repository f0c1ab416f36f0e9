import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foliograph.session import local_session, reach_package


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    reach_package(session)
    yield session
    session.stop()
