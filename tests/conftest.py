import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomis.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="loomis-test-ckpt-", dir="/tmp")
    s = build_session(master="local[4]", shuffle_partitions=4, app="loomis-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
