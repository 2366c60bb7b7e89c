from __future__ import annotations

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.timestampType", "TIMESTAMP_NTZ")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def stamp(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def series(spark):
    """Build a half-hour series from a list of values (None is a gap)."""

    def build(values, start="2024-02-28 22:00:00", key="a", step_minutes=30):
        first = stamp(start)
        rows = [
            (key, first + dt.timedelta(minutes=step_minutes * i), None if v is None else float(v))
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")

    return build
