import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("tastemap-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def interactions(spark, rows, with_ts=True):
    """Small interaction frame from (user, item, rating[, ts]) tuples."""
    if with_ts:
        return spark.createDataFrame(rows, "user_id int, item_id int, rating double, ts long")
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double")


def scores(spark, rows):
    return spark.createDataFrame(rows, "user_id int, item_id int, score double")
