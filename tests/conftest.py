import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shopflow.session import checkpoint_dir, get_session

    s = get_session(master="local[4]", shuffle_partitions=4, app_name="shopflow-tests")
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a scratch folder stands in for the cluster's shared folder
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="shopflow-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shopflow-test-", dir="/tmp")
