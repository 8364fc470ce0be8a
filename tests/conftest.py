from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("lakeloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples; NULL sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan_of(df):
    """The physical plan as text, after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
