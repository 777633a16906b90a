import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lathework.session import get_spark

    session = get_spark("local[4]", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
