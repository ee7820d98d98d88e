import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    state = tempfile.mkdtemp(prefix="tidemark-tests-")
    s = (SparkSession.builder.master("local[4]")
         .appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", os.path.join(state, "warehouse"))
         .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={state}")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(os.path.join(state, "checkpoints"))
    s.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    yield s
    s.stop()
