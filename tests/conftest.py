import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrina.session import build_session  # noqa: E402

AS_OF = "2024-06-30 12:00:00"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="vitrina-tests", driver_memory="6g")
    yield s
    s.stop()
