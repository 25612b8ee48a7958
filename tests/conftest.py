from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from quayside.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/shared",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf() -> str:
    return "/root/testdata/sf0.001"
