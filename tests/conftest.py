from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark():
    from rollbook.session import local_session

    session = local_session("rollbook-tests", cores=8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
