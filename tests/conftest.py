import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]").appName("ballotbox-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    spark = builder.getOrCreate()
    # Tests set their own checkpoint folder only when the session has none.
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ballotbox-test-ckpt-"))
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture
def scratch(spark):
    from ballotbox.session import scratch_path

    return lambda name: scratch_path(spark, name)
