import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from payspark.session import build_session, use_checkpoints  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("payspark-tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    use_checkpoints(s, tempfile.mkdtemp(prefix="payspark-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
