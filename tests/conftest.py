import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from quaybook.session import SCALE_SETTINGS, ensure_checkpoint_dir
    builder = (SparkSession.builder.master("local[*]").appName("quaybook-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quaybook-test-ckpt-")))
    for k, v in SCALE_SETTINGS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quaybook-test-")
