import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tierline.session import DEFAULT_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("tierline-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
