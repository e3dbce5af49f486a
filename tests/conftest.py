import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.schema import RAW  # noqa: E402
from retail_rows import EDGE_ROWS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("mercato-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mercato-test-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def edge_raw(spark):
    return spark.createDataFrame(EDGE_ROWS, RAW)


@pytest.fixture(scope="session")
def edge(spark, edge_raw):
    from mercato.plans.catalog import Retail
    from mercato.plans.clean import clean

    return Retail.from_clean(spark, clean(edge_raw), raw=edge_raw)
