import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("TZ", "UTC")

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bookflow.session import build_session

    s = build_session("local[4]", app="bookflow-tests", shuffle_partitions=4)
    # Tests own their session, so they may name a checkpoint folder.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bookflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="run-")
