import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from daybridge.session import prepare


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("daybridge-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
               .config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
