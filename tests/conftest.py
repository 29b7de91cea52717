import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from txquality.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4", "spark.python.sql.dataFrameDebugging.enabled": "false"}
    session = build_session("tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
