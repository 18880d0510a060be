import os

os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest  # noqa: E402

from partsieve.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, spark__sql__shuffle__partitions="4")  # the tables are tiny
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
