import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadpulse.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="roadpulse-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rp-ckpt-"))
    checkpoint_root(s)
    yield s


@pytest.fixture()
def workdir(spark):
    # a fresh folder per test under the shared checkpoint folder
    from roadpulse.session import scratch_path
    return scratch_path(spark, "tests")
