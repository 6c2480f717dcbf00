import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from replyscope.session import build_session
    ckpt = tempfile.mkdtemp(prefix="replyscope-test-ckpt-", dir="/tmp")
    s = build_session("local[*]", shuffle_partitions=8,
                      conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMOKE
