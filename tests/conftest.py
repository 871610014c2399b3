import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from curvethin.session import local_session, checkpoint_dir

    s = local_session("*", shuffle_partitions=8, app="curvethin-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


SF = os.environ.get("CURVETHIN_TEST_SF", "/root/testdata/sf0.01")
SF_SMALL = "/root/testdata/sf0.001"
