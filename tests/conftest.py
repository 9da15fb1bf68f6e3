import os

import pytest

from marginalia.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF_DIR


@pytest.fixture(scope="session")
def con(folder):
    from tests.checker import connect

    return connect(folder)
