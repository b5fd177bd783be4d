"""One local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riftspan.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "riftspan-tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def write(tmp_path):
    """Write lines to a file of the test folder and return its path."""

    def save(name, lines):
        path = tmp_path / name
        path.write_text("".join(line + "\n" for line in lines))
        return str(path)

    return save
