import os
import sys
import tempfile
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="strata-test-")
    session = build_session(
        "local[4]",
        app_name="strata-tests",
        shuffle_partitions=4,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    # tests pick their own checkpoint folder only when the session has none
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="strata-case-")


def ts(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 1, day, hour, 0, 0)
