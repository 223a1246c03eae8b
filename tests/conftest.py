import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from heightgrid.session import build_session

    session = build_session("tests", cores="8", shuffle_partitions=8)
    yield session
    session.stop()
