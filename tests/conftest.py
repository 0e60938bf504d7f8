import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from sparkbrook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.warehouse.dir": "/tmp/sparkbrook-warehouse"}
    session = build_session("tests", "local[8]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
