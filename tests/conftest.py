import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickline.session import use_rocksdb  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tickline-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "6g")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    use_rocksdb(session)
    yield session
    session.stop()


@pytest.fixture
def at():
    """at(minutes) -> a moment of 1 January 2024."""
    start = dt.datetime(2024, 1, 1)
    return lambda minutes: start + dt.timedelta(minutes=minutes)


def rows(df, *columns):
    """Sorted tuples of a DataFrame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
