import pytest

from check_queries import database

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def con():
    return database(SMALL)
