import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tape.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tape-test-ckpt-")
    s = get_session("local[4]", app="tape-tests", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
