import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courierlake.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8",
           "spark.driver.memory": "8g",
           "spark.sql.warehouse.dir": str(base / "warehouse"),
           "spark.checkpoint.dir": str(base / "checkpoints"),
           "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    return TESTDATA


@pytest.fixture(scope="session")
def small(testdata):
    return f"{testdata}/sf0.001"
