from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tallyspark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="tallyspark-test-")
