import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("webfeed-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def feeds(spark):
    """The driver-contract test feeds at sf0.001."""
    from webfeed.testing import fixtures

    return fixtures.build(spark, SF_SMALL)


@pytest.fixture
def workdir():
    """A fresh local folder for hand-made deliveries."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
