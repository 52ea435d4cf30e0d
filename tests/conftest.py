"""One Spark session for all tests."""

import pytest

from fieldkit.session import drop_settled, local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_settled(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL
