import pytest

from rollcall.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, app="rollcall-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
