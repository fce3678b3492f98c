import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from churnlens.session import local_session
    s = local_session("*", shuffle_partitions=8, app="churnlens-tests")
    yield s
    s.stop()


@pytest.fixture
def edge_frame(spark):
    def make(edges):
        return spark.createDataFrame(edges, "src string, dst string").select("dst", "src")
    return make


@pytest.fixture
def id_frame(spark):
    def make(ids):
        return spark.createDataFrame([(i,) for i in ids], "id string")
    return make
