import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from recspark.session import build_session, checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=4, app="recspark-tests")
    checkpoint_dir(s)
    yield s
    s.stop()
