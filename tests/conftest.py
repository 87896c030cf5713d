import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from gridtally import configure  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gridtally-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_small() -> str:
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def sf_medium() -> str:
    return str(TESTDATA / "sf0.01")


@pytest.fixture(autouse=True)
def without_reliance(spark):
    """Registered queries dealt by contract and month leave their settings in the session: they end with the test."""
    yield
    if spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false":
        configure(spark)
