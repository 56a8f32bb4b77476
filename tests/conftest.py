from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from cadastra.session import tune


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("cadastra-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
