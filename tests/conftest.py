import pytest


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session("tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
