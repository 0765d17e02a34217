import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from playtrack.session import SESSION_DEFAULTS

    builder = SparkSession.builder.master("local[4]").appName("playtrack-tests")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if s.sparkContext.getCheckpointDir() is None and s.conf.get("spark.checkpoint.dir", None) is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="playtrack-test-ckpt-"))
    yield s
