import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

import samples  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    """The sample Bronze tables by combination."""
    return {c: spark.createDataFrame(rows, ddl) for c, (ddl, rows) in samples.BRONZE.items()}


def rows(df, *columns):
    """Rows as sorted plain tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="session")
def as_rows():
    return rows
