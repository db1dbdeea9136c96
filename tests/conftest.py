import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vendorscope.session import build_session
    s = build_session("local[*]", 8, extra={"spark.driver.memory": "4g"})
    # Tests run without a cluster: name a checkpoint folder only because none is set.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vs-test-ckpt-"))
    yield s
    s.stop()
