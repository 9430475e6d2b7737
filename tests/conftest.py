from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from aerolith.session import build_session, checkpoint_dir

    session = build_session(
        "aerolith-tests", master="local[4]", shuffle_partitions=4, extra_conf={"spark.driver.memory": "6g"}
    )
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="aerolith-test-")
