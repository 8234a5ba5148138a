import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fleetline.session import checkpoint_dir, get_session
    s = get_session(master="local[*]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return tmp_path
