from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import ROCKSDB_PROVIDER, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.streaming.noDataProgressEventInterval": "100",
    }
    session = local_session(4, "tidemark-tests", **conf)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL
