import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import build_session

    s = build_session("local[4]", "cadenza-tests", {"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()
