import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexiloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.conf.set("spark.sql.shuffle.partitions", "8")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def apply(spark):
    """Run a Column function over texts and return the results in order."""
    from pyspark.sql import functions as F

    def run(function, *texts):
        rows = list(enumerate(texts))
        df = spark.createDataFrame(rows, "i INT, t STRING").coalesce(1)
        return [r.out for r in df.orderBy("i").select(function(F.col("t")).alias("out")).collect()]

    return run
