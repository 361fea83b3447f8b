import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark import SparkConf
    from pyspark.sql import SparkSession

    b = (SparkSession.builder.master("local[4]").appName("aerolith-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="aerolith-wh-"))
         .config("spark.sql.session.timeZone", "UTC"))
    if not SparkConf().get("spark.checkpoint.dir", None):  # one machine: a local folder is shared
        b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aerolith-test-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="aerolith-t-")
