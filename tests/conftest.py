import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollcall.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rollcall-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(autouse=True)
def fresh_settings(spark):
    configure(spark)
    spark.conf.set("spark.sql.caseSensitive", "false")
    yield


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
