import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rollwise.session import get_spark, shared_dir
    s = get_spark(master="local[4]", shuffle_partitions=4)
    shared_dir(s)  # tests: a private temp folder as the checkpoint dir
    yield s
