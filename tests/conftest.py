import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tradewind.session import local_session
    # Tests set their own checkpoint folder: the session has none.
    ckpt = tempfile.mkdtemp(prefix="tradewind-test-ckpt-")
    s = local_session("*", 8, app_name="tradewind-tests", extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()
