import pytest

from cliploom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sql(folder):
    from tests.compare import open_tables

    return open_tables(folder)
