import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from salescope.session import build_session, shared_dir
    s = build_session("local[*]", shuffle_partitions=8, app_name="salescope-tests")
    shared_dir(s)            # registers a private checkpoint folder only if none is set
    yield s
    s.stop()
