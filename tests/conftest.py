"""One local session for all tests."""

import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, *filter(None, [os.environ.get("PYTHONPATH")])])

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.warehouse.dir", f"{folder}/warehouse").config("spark.checkpoint.dir", f"file://{folder}/shared").config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
