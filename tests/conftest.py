import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="gw-tests-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from gaugeworks.session import local_session

    s = local_session("gaugeworks-tests", cores="*", shuffle_partitions=8, scratch=scratch)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_new(scratch):
    return tempfile.mkdtemp(prefix="case-", dir=scratch)
