from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerpulse.session import local_session

    session = local_session(8, "tests", "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return SMALL
