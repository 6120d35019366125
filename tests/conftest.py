import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from vigil.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8)
    checkpoint_dir(s)  # tests only: sets a local folder because none is configured
    yield s


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)
