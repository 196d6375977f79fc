import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


SESSION = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
           .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
           .config("spark.driver.memory", "6g").getOrCreate())
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one Column on one row."""
    def run(column, **inputs):
        rows = spark.createDataFrame([tuple(inputs.values())], list(inputs)) if inputs else spark.range(1)
        return rows.select(column.alias("v")).first()["v"]

    return run
