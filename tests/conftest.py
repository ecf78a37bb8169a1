import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    import tempfile

    session = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoints-")).config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
