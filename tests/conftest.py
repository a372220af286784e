import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from plazalens.session import get_session

    s = get_session("local[4]", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
