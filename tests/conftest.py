import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gridspark.session import get_spark

    base = tmp_path_factory.mktemp("spark")
    session = get_spark("tests", "local[8]", 4, **{
        "spark.checkpoint.dir": str(base / "shared"), "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
