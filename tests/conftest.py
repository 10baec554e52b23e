import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if s.sparkContext.getCheckpointDir() is None:
        import tempfile
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ckpt-"))
    return s
