import os
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if REPO not in sys.path:
    sys.path.insert(0, REPO)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tierstore.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    # tests set their own shared folder only where the session names none
    if not (s.sparkContext.getConf().get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
