import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from meterlake.session import build_session
    # plans print the paths they read whole, however long the temp folder's name is
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ml-tests-"),
                             "spark.sql.maxMetadataStringLength": "1000"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_new():
    return tempfile.mkdtemp(prefix="ml-run-")
