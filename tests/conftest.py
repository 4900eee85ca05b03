import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    b = (SparkSession.builder.master("local[4]").appName("tidewater-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from tidewater.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="tidewater-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    from tidewater.session import work_dir
    return work_dir(spark, "test")
