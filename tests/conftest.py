import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapdelta.session import DEFAULTS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("snapdelta-tests")
    settings = {
        **DEFAULTS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=str)

    return collect


@pytest.fixture
def snap(spark):
    """Envelope snapshot of ``(id, a, b)`` rows."""
    from snapdelta.operators.envelope import to_envelope

    def build(data, day="2024-01-02", table="t", null_safe=False, keys=("id",)):
        df = spark.createDataFrame(data, "id STRING, a STRING, b STRING")
        return to_envelope(df, table, list(keys), day, null_safe)

    return build
