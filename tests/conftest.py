import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="tallyline-test-")
    spark = (
        SparkSession.builder.master("local[*]")
        .appName("tallyline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tallyline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))
    yield spark


@pytest.fixture(scope="module", autouse=True)
def cached_frames_end_with_their_module():
    """Spark puts a cached frame into any later plan that is the same."""
    from pyspark.sql import SparkSession

    yield
    if session := SparkSession.getActiveSession():
        session.catalog.clearCache()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tallyline-case-")
