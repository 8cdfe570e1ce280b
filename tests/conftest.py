import datetime as dt

import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4)


@pytest.fixture
def at():
    """``at("2026-08-09 12:00:00")`` as an aware UTC datetime."""

    def parse(text):
        return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)

    return parse
