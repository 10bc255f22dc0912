import datetime as dt

import pytest

from weirgate.session import build_session, work_dir
from weirgate.spec import Layout


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")


@pytest.fixture
def layout(folder):
    return Layout(folder)


@pytest.fixture
def noon():
    return dt.datetime(2024, 2, 1, 12, tzinfo=dt.timezone.utc)
