import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session, checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=4, app="tessera-tests")
    checkpoint_dir(s)
    yield s
    s.stop()
