import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("tessera-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    sc = s.sparkContext
    # tests set their own checkpoint folder only where the session has none
    if not sc.getCheckpointDir() and not sc.getConf().get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def articles(spark):
    def make(rows):
        return spark.createDataFrame(rows, "title string, text string")
    return make
