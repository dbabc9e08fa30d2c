import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("recordmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture
def evaluate(spark):
    """Applies a column function to (input, expected) pairs in one job."""

    def run(function, cases):
        rows = [(i, given) for i, (given, _) in enumerate(cases)]
        df = spark.createDataFrame(rows, "i int, given string")
        got = {r.i: r.value for r in df.select("i", function(df.given).alias("value")).collect()}
        wrong = [
            (given, expected, got[i])
            for i, (given, expected) in enumerate(cases) if got[i] != expected
        ]
        assert wrong == []

    return run
