import pytest

from granary.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "granary-tests")
    yield session
    session.stop()
