import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from check_oracle import session
    s = session(8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con():
    from check_oracle import duck
    return duck(SMALL)


@pytest.fixture()
def sf():
    return SMALL
