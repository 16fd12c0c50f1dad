import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from offerlake.session import build_session

    ckpt = tempfile.mkdtemp(prefix="offerlake-test-ckpt-")
    s = build_session(
        app_name="offerlake-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="offerlake-test-lake-")
