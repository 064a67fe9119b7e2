import pytest

from haulgrid.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mart(spark):
    from haulgrid.sources.mart import mart_for

    return mart_for(spark, SMALL)
