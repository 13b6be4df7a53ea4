import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tellus.session import get_session
    extra = {}
    s = get_session("tellus-tests", master="local[4]", shuffle_partitions=8,
                    extra={"spark.sql.adaptive.coalescePartitions.enabled": "true", **extra})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tellus-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tellus-test-")
