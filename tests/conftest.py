import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from scorewatch.session import local_session
    s = local_session("*", 8, app="scorewatch-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scorewatch-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def ts(text):
    import datetime as dt
    return None if text is None else dt.datetime.fromisoformat(text)
