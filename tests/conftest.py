import pytest

from loanfold.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "loanfold-tests", memory="6g")
    yield session
    session.stop()
