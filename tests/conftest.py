import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from paddock.session import apply_defaults

    b = SparkSession.builder.master("local[4]").appName("paddock-tests").config("spark.ui.enabled", "false")
    b = b.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):  # a folder only where none is named
        b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="paddock-test-ckpt-"))
    s = b.getOrCreate()
    apply_defaults(s)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
