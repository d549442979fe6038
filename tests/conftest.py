import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import build_session
    s = build_session("local[8]", "tidepool-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g",
                             "spark.tidepool.minInputPartitions": "8"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tp-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con():
    from tests.oracle_compare import duck
    return duck(SF01)
