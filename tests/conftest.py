import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rxlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="rxlake-tests-")
    session = build_session(
        "rxlake-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.local.dir": scratch,
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rxlake-t-")
