from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("wattledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).is_dir():
        pytest.skip(f"no test data at {SF_DIR}")
    return SF_DIR


@pytest.fixture(scope="session")
def grid(spark, sf_dir):
    from verification.adapters import GridTables

    return GridTables(spark, sf_dir)


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema -> DataFrame; timestamps as text."""

    def build(rows, schema: str):
        df = spark.createDataFrame(rows, schema)
        return df.withColumn("timestamp", df["timestamp"].cast("timestamp_ntz")) if "timestamp" in df.columns else df

    return build


def values(df, *columns):
    """Collected rows as a sorted list of tuples of the named columns (all by default)."""
    names = columns or df.columns
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)
