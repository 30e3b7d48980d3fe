import datetime as dt
import os
import time

# Naive datetimes that enter and leave Spark are read in the process's zone.
os.environ["TZ"] = "UTC"
time.tzset()

import pytest
from pyspark.sql import SparkSession

from tallyworks.session import configure

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are missing")
    return SMALL


def ts(text: str) -> dt.datetime:
    """An instant given in UTC, as Spark takes and returns it in this process."""
    return dt.datetime.fromisoformat(text)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
