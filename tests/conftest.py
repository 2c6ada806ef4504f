import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Rows as tuples and a DDL schema to a DataFrame; timestamps as text."""
    def build(rows, ddl):
        wanted = spark.createDataFrame([], ddl).schema
        text = ", ".join(f"`{f.name}` string" for f in wanted.fields)
        cells = [tuple(None if v is None else str(v) for v in r) for r in rows]
        df = spark.createDataFrame(cells, text)
        return df.select(*[df[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in wanted.fields])
    return build
