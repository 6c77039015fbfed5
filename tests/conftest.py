import pytest

from opspark import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("opspark-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
