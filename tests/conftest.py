import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from basinflow.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="basinflow-tests")
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def days(start: dt.date, end: dt.date):
    cur = start
    while cur <= end:
        yield cur
        cur += dt.timedelta(days=1)
