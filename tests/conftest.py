import pytest

from sieveline.plans.runtime import session, ship


@pytest.fixture(scope="session")
def spark():
    s = session(4, 4, "3g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
