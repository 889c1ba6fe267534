from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wagegrid.config import session

    folder = str(tmp_path_factory.mktemp("checkpoints"))
    s = session(master="local[*]", app="wagegrid-tests", shuffle_partitions=8,
                conf={"spark.checkpoint.dir": folder})
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from wagegrid.config import scratch_path

    def make(name: str = "t") -> str:
        return scratch_path(spark, name)
    return make
