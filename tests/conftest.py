import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def spark():
    from sluiceway.session import local_session, ship_package

    session = local_session("8", 8)
    ship_package(session)
    yield session
    session.stop()
