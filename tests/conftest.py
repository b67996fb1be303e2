import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlake.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="ll-warehouse-")
    session = build_session("ledgerlake-tests", "local[4]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": warehouse,
    })
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_root(session)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ll-test-")
