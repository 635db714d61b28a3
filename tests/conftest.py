import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskpanel.session import get_session
    ck = tempfile.mkdtemp(prefix="riskpanel-test-ckpt-")
    s = get_session("local[4]", 4, extra={"spark.checkpoint.dir": ck})
    s.sparkContext.setCheckpointDir(ck)
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from riskpanel.sources.bindings import bind
    return bind(spark, SF_SMALL)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="riskpanel-test-")
