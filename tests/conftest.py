import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import local_session
    s = local_session(cpus=4, partitions=4)
    yield s
    s.stop()
