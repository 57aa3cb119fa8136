import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
