import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import make_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = make_session(master="local[*]", shuffle_partitions=8, app_name="quarry-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-tests-"))  # a cluster names its own
    yield s
    s.stop()
