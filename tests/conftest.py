import pytest

from cliploom.session import build_session
from tests.compare import open_tables

TABLES_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TABLES_DIR


@pytest.fixture(scope="session")
def sql(folder):
    return open_tables(folder)
