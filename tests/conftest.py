import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")
