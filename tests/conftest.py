import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ordermart.plans.session import build_session, use_local_scratch
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="ordermart-tests")
    use_local_scratch(s)
    yield s
    s.stop()
