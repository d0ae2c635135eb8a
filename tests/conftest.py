import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from issuelens.session import build_session
    s = build_session("local[4]", 4, app_name="issuelens-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="issuelens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="issuelens-test-")


def fixture_path(name: str) -> str:
    return os.path.join(FIXTURES, name)
