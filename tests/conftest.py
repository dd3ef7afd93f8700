import pytest

from foliant.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
