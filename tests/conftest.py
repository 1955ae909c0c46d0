import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tradewind-tests", shuffle_partitions=8)
    # Tests run locally: no cluster folder is configured, so set our own.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradewind-test-ckpt-"))
    yield s
    s.stop()
