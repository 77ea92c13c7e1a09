import sys

import pytest
from locations import ROOT

if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from postlake.session import local_session, shared_dir

    s = local_session(cores=4, shuffle_partitions=8)
    shared_dir(s)
    yield s


@pytest.fixture
def one_col(spark):
    def make(values, name="x"):
        return spark.createDataFrame([(v,) for v in values], f"{name} string")

    return make
