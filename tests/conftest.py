from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from stackroom.functions.ids import IdScheme  # noqa: E402
from stackroom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def scheme():
    return IdScheme("example.org")
